"""Sections to overlapping chunks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Tried in order; the empty one cuts between any two characters.
SEPARATORS = ("\n\n", "\n", " ", "")


def split_recursively(text: str, size: int, overlap: int, separators=SEPARATORS) -> list[str]:
    """Pieces of at most ``size`` characters, cut at the coarsest separator that fits.

    A separator stays at the start of the piece it opens. Short pieces are
    packed into one chunk; the tail of a chunk, up to ``overlap`` characters,
    opens the next.
    """
    at = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    separator, finer = separators[at], separators[at + 1 :]
    if separator:
        head, *tail = text.split(separator)
        pieces = [p for p in [head, *(separator + t for t in tail)] if p]
    else:
        pieces = list(text)

    chunks, run = [], []
    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
            continue
        chunks += _pack(run, size, overlap)
        run = []
        chunks += split_recursively(piece, size, overlap, finer) if finer else [piece]
    return chunks + _pack(run, size, overlap)


def _pack(pieces: list[str], size: int, overlap: int) -> list[str]:
    packed, first, length = [], 0, 0
    for i, piece in enumerate(pieces):
        if first < i and length + len(piece) > size:
            packed.append("".join(pieces[first:i]).strip())
            while length > overlap or (length > 0 and length + len(piece) > size):
                length -= len(pieces[first])
                first += 1
        length += len(piece)
    packed.append("".join(pieces[first:]).strip())
    return [p for p in packed if p]


def chunk_texts(size: int, overlap: int):
    """Arrow function from text to its list of chunks."""
    if overlap > size:
        raise ValueError("overlap must not exceed size")

    @F.pandas_udf("array<string>")
    def chunk(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [] if t is None else split_recursively(t, size, overlap))

    return chunk


def chunk_sections(sections: DataFrame, size: int, overlap: int, text: str = "text") -> DataFrame:
    """Section rows to chunk rows: the text replaced, ``chunk_pos`` added, the rest copied."""
    kept = [c for c in sections.columns if c != text]
    return sections.select(*kept, F.posexplode(chunk_texts(size, overlap)(F.col(text))).alias("chunk_pos", text))


class ChunkText:
    """Table function ``(text, size, overlap)`` to rows ``(chunk_pos, chunk)``."""

    def eval(self, text: str, size: int, overlap: int):
        yield from enumerate(split_recursively(text or "", size, overlap))


def register_chunk_text(spark: SparkSession, name: str = "chunk_text") -> None:
    """Make the splitter available to SQL: ``FROM sections, LATERAL chunk_text(text, 700, 50)``."""
    spark.udtf.register(name, F.udtf(ChunkText, returnType="chunk_pos int, chunk string"))


def last_window(length: Column, size: int | Column, overlap: int | Column) -> Column:
    """Number of the last window: later ones would hold overlap only."""
    return F.greatest(F.floor((length - overlap - 1) / (size - overlap)), F.lit(0))


def chunk_fixed(sections: DataFrame, size: int, overlap: int, text: str = "text") -> DataFrame:
    """Fixed windows with starts ``0, size - overlap, ...``; none is overlap only.

    The text is cut once into pieces of ``size - overlap`` characters; a window
    is its piece and the start of those after it, so long texts cost no more
    per character than short ones.
    """
    step = size - overlap
    if step <= 0:
        raise ValueError("overlap must be smaller than size")
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    kept = [c for c in sections.columns if c != text]
    cut = sections.where(F.col(text).isNotNull()).select(
        *kept, pieces.alias("_p"), last_window(F.length(text), size, overlap).cast("int").alias("_last")
    )
    spanned = -(-size // step)
    windows = F.transform(
        F.sequence(F.lit(0), F.col("_last")),
        lambda i: F.left(F.array_join(F.slice("_p", i + 1, F.lit(spanned)), ""), F.lit(size)),
    )
    return cut.select(*kept, F.posexplode_outer(windows).alias("chunk_pos", text))


def chunk_size_sweep(sections: DataFrame, sizes: list[int], overlap: int, text: str = "text") -> DataFrame:
    """``(chunk_size, n_chunks, mean_length)`` of fixed windows for each size, in one pass.

    All windows but the last are full, so counts and lengths follow from the
    text's length and no window has to be cut.
    """
    sized = sections.where(F.col(text).isNotNull()).select(
        F.length(text).alias("_n"), F.explode(F.array(*[F.lit(s) for s in sizes])).alias("chunk_size")
    )
    size = F.col("chunk_size")
    placed = sized.withColumn("_last", last_window(F.col("_n"), size, overlap))
    chars = F.col("_last") * size + F.least(size, F.col("_n") - F.col("_last") * (size - overlap))
    return (
        placed.groupBy("chunk_size")
        .agg(F.sum(F.col("_last") + 1).alias("n_chunks"), F.sum(chars).alias("_chars"))
        .select("chunk_size", "n_chunks", F.round(F.col("_chars") / F.col("n_chunks"), 6).alias("mean_length"))
    )
