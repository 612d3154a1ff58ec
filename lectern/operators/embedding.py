"""Batch embedding: any encoder, loaded once per task; a hashing one ships."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructType

from lectern.operators.batches import pieces

# Rows handed to an encoder at once.
BATCH_ROWS = 100
# Most bytes of rows handed to an encoder at once; splitting their texts into words takes some twenty times as much memory.
ENCODED_BYTES = 1 << 20

# Key of a vector column's metadata.
ENCODER = "encoder_id"
Encoder = Callable[[pa.Array], np.ndarray]


class HashedWords:
    """Hashed bag of words, scaled to unit length; a text without words gives zeros.

    The bucket of a word is the first eight hex digits of its MD5, modulo ``dim``.
    """

    def __init__(self, dim: int = 256):
        self.dim = dim
        self.encoder_id = f"hashed-words-{dim}"
        self.batch_rows = max(BATCH_ROWS, 256_000 // dim)

    def __call__(self) -> Encoder:
        return self.encode

    def bucket(self, word: str) -> int:
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % self.dim

    def encode(self, texts: pa.Array) -> np.ndarray:
        clean = pc.ascii_lower(pc.replace_substring_regex(texts.fill_null(""), "[^a-zA-Z0-9]+", " "))
        tokens = pc.split_pattern(pc.ascii_trim_whitespace(clean), " ")
        lengths = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        coded = tokens.flatten().dictionary_encode()
        buckets = np.array([self.bucket(w) if w else -1 for w in coded.dictionary.to_pylist()], dtype=np.int64)
        row = np.repeat(np.arange(len(texts)), lengths)
        bucket = buckets[coded.indices.to_numpy(zero_copy_only=False)] if len(row) else np.empty(0, np.int64)
        cell = (row * self.dim + bucket)[bucket >= 0]
        counts = np.bincount(cell, minlength=len(texts) * self.dim).reshape(len(texts), self.dim).astype(float)
        norms = np.sqrt((counts**2).sum(axis=1, keepdims=True))
        return np.divide(counts, norms, out=np.zeros_like(counts), where=norms > 0)


def float_lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as an Arrow list column of floats."""
    n, dim = matrix.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * np.int32(dim))
    return pa.ListArray.from_arrays(offsets, pa.array(matrix.astype(np.float32).ravel()))


def embed(df: DataFrame, encoder_factory, text: str = "text", out: str = "embedding") -> DataFrame:
    """All columns plus the vector of ``text``.

    ``encoder_factory()`` runs once per task and returns a function from an
    Arrow array of texts to a matrix.
    """
    schema = StructType([*df.schema.fields]).add(out, ArrayType(FloatType(), False))
    rows = getattr(encoder_factory, "batch_rows", BATCH_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder_factory()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                for piece in pieces(batch.slice(start, rows), ENCODED_BYTES):
                    vectors = float_lists(np.asarray(encode(piece.column(text))))
                    yield pa.RecordBatch.from_arrays([*piece.columns, vectors], [*piece.schema.names, out])

    encoder_id = getattr(encoder_factory, "encoder_id", None)
    vectors = df.mapInArrow(run, schema)
    return with_encoder(vectors, encoder_id, out)


def encoder_of(df: DataFrame, vector: str = "embedding") -> str | None:
    """The encoder that made a column of vectors, where it is known; stored tables keep it."""
    return df.schema[vector].metadata.get(ENCODER)


def with_encoder(df: DataFrame, name: str | None, vector: str = "embedding") -> DataFrame:
    """The same rows, with the encoder that made their vectors."""
    return df.withMetadata(vector, {ENCODER: name}) if name else df


def require_same_encoder(one: DataFrame, other: DataFrame, vector: str = "embedding") -> None:
    """Vectors of two different encoders cannot be compared."""
    names = encoder_of(one, vector), encoder_of(other, vector)
    if None not in names and names[0] != names[1]:
        raise ValueError(f"vectors of {names[0]} and {names[1]} cannot be compared")


def embed_chunks(chunks: DataFrame, encoder_factory=None, text: str = "text") -> DataFrame:
    """Chunks with their vectors."""
    return embed(chunks, encoder_factory or HashedWords(), text)


def embed_queries(questions: DataFrame, encoder_factory=None, text: str = "question") -> DataFrame:
    """Questions with their vectors; use the index's encoder."""
    return embed(questions, encoder_factory or HashedWords(), text)


def vector_entries(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Long form of the non-zero entries: ``(key, pos, value)``."""
    return df.select(key, F.posexplode(vector).alias("pos", "value")).where("value <> 0")


def mean_vectors(vectors: DataFrame, by: str, vector: str = "embedding") -> DataFrame:
    """``(by, vector)``: mean vector per group, with partial means in every task."""
    # Here, as every Python worker that makes vectors would load them, with pandas: 44 MB each.
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    mean = Summarizer.mean(array_to_vector(vector))
    return vectors.groupBy(by).agg(vector_to_array(mean).alias(vector))
