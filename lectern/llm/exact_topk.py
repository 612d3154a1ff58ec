"""Exact top-k search by inner product over norm-sorted, SVD-rotated vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.arrow import batches
from lectern.session import materialize, scratch_path

# Queries that travel with the function at once.
QUERY_BLOCK = 16_384
# Vectors scored against a query block at once, and rows of a block that share one sort by length.
TILE, SORTED_ROWS = 1024, 1 << 16
# Sums of whole numbers below this are exact in doubles.
EXACT = float(1 << 53)
# Stands for no score.
LOWEST = np.iinfo(np.int64).min


def clean_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``id, v``: rows that have an id and a vector of finite numbers alone."""
    values = F.col(vector).cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(vec_id).cast("long").alias("id"), values.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~odd)


def matrix_of(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """floor(scale * x) of a list column as doubles, shorter vectors filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale)
    out = np.zeros((len(sizes), dims))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rotation(vectors: DataFrame, dims: int, scale: float) -> np.ndarray:
    """The right singular vectors of all vectors together, from sums of products made where the rows are."""

    def work(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in it:
            m = matrix_of(batch.column(1), dims, scale)
            m /= np.maximum(np.abs(m).max(axis=1, keepdims=True, initial=0), 1)
            total += m.T @ m
        i, j = np.triu_indices(dims)
        schema = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("s", pa.float64())])
        yield batches({"i": i.astype(np.int32), "j": j.astype(np.int32), "s": total[i, j]}, schema)

    sums = vectors.mapInArrow(work, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toArrow()
    gram = np.zeros((dims, dims))
    gram[sums["i"].to_numpy(), sums["j"].to_numpy()] = sums["s"].to_numpy()
    gram += np.triu(gram, 1).T
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


@dataclass
class Best:
    """The k best candidates of each query so far, best first; empty places have the id -1."""

    score: np.ndarray
    vec_id: np.ndarray
    filled: np.ndarray

    @classmethod
    def none(cls, queries: int, k: int) -> Best:
        return cls(np.full((queries, k), LOWEST), np.full((queries, k), -1, np.int64), np.zeros(queries, np.int64))

    def bar(self) -> np.ndarray:
        """The score a newcomer must reach at least."""
        return np.where(self.filled == self.score.shape[1], self.score[:, -1], LOWEST)

    def add(self, q: np.ndarray, vec_id: np.ndarray, score: np.ndarray) -> None:
        k = self.score.shape[1]
        touched = np.unique(q)
        held = np.arange(k)[None, :] < self.filled[touched][:, None]
        q = np.concatenate([q, np.repeat(touched, self.filled[touched])])
        vec_id = np.concatenate([vec_id, self.vec_id[touched][held]])
        score = np.concatenate([score, self.score[touched][held]])
        order = np.lexsort((vec_id, -score, q))
        q, vec_id, score = q[order], vec_id[order], score[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (vec_id[1:] != vec_id[:-1])
        q, vec_id, score = q[new], vec_id[new], score[new]
        first = np.searchsorted(q, touched)
        rank = np.arange(len(q)) - first[np.searchsorted(touched, q)]
        keep = rank < k
        self.score[q[keep], rank[keep]], self.vec_id[q[keep], rank[keep]] = score[keep], vec_id[keep]
        self.filled[touched] = np.minimum(np.diff(np.concatenate([first, [len(q)]])), k)


class Searcher:
    """A block of queries, rotated, with the lengths of what the leading dimensions leave over."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, basis: np.ndarray, k: int, lead: int):
        self.ids, self.vectors, self.basis, self.lead = ids, vectors, basis, lead
        self.rotated = vectors @ basis
        self.length = np.linalg.norm(vectors, axis=1)
        self.rest = np.linalg.norm(self.rotated[:, lead:], axis=1)
        self.best = Best.none(len(ids), k)
        self.largest = np.abs(vectors).max(initial=0)

    def exact(self, q: np.ndarray, vectors: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The scores of pairs, whole numbers: in doubles where those hold them exactly, else in Python's integers."""
        if self.largest * np.abs(vectors).max(initial=0) * vectors.shape[1] >= EXACT:
            found = [sum(int(x) * int(y) for x, y in zip(self.vectors[i].tolist(), vectors[j].tolist())) for i, j in zip(q, at)]
            if any(abs(x) >= 1 << 63 for x in found):
                raise ValueError("a score does not fit into 64 bits")
            return np.array(found, np.int64)
        parts = [slice(i, i + 65536) for i in range(0, max(len(q), 1), 65536)]
        return np.concatenate([np.einsum("ij,ij->i", self.vectors[q[p]], vectors[at[p]]) for p in parts]).astype(np.int64)

    def see(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take some candidates into account, longest first, until no query can gain."""
        length = np.linalg.norm(vectors, axis=1)
        order = np.argsort(-length, kind="stable")
        for lo in range(0, len(order), TILE):
            tile = order[lo : lo + TILE]
            bar = self.best.bar()
            slack = 1e-9 * self.length * length[tile[0]] + 1e-6
            active = np.flatnonzero(self.length * length[tile[0]] + slack >= bar)
            if not len(active):
                return
            rotated = vectors[tile] @ self.basis
            rest = np.linalg.norm(rotated[:, self.lead :], axis=1)
            bound = self.rotated[active, : self.lead] @ rotated[:, : self.lead].T
            bound += self.rest[active, None] * rest[None, :]
            q, at = np.nonzero(bound >= (bar - slack)[active, None])
            q = active[q]
            other = self.ids[q] != ids[tile][at]
            q, at = q[other], at[other]
            score = self.exact(q, vectors[tile], at)
            gain = score >= bar[q]
            if gain.any():
                self.best.add(q[gain], ids[tile][at[gain]], score[gain])

    def rows(self, schema: pa.Schema) -> pa.RecordBatch:
        held = np.arange(self.best.score.shape[1])[None, :] < self.best.filled[:, None]
        score = self.best.score[held]
        return batches({"query_id": np.repeat(self.ids, self.best.filled), "vec_id": self.best.vec_id[held], "score": score}, schema)


def exact_topk(
    corpus: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vector: str = "embedding",
    scale: float = 256.0, lead: int | None = None, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its k best others by the inner product of floor(scale * x).

    Candidates stay where they are: each task sorts what it reads by length and
    scores it against a block of queries; ``lead`` rotated dimensions are summed,
    the rest is bounded by Cauchy-Schwarz, and what the bound leaves is computed
    exactly. Queries come in blocks of about ``query_block`` (the most that the
    driver holds); each block is one pass. A query's own id is no candidate.
    Equal scores rank the smaller id first, a repeated id counts once, fewer
    candidates give fewer rows. Rows without id or vector, or with components
    that are null or not finite, take no part; of vectors of different lengths
    the shorter is filled up with zeros; scores are exact up to 64 bits, and one
    beyond them is an error. Empty tables give an empty result; other columns are
    not read.
    """
    if k < 1:
        raise ValueError("k must be positive")
    spark = corpus.sparkSession
    vectors = clean_vectors(corpus, vec_id, vector)
    asked = materialize(clean_vectors(queries, vec_id, vector).dropDuplicates(["id"]), "topk-queries")
    n, dims = asked.agg(F.count("*"), F.max(F.size("v"))).first()
    ddl = "query_id long, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(dims, vectors.agg(F.max(F.size("v"))).first()[0] or 0, 1)
    basis = rotation(vectors, dims, scale)
    lead = min(lead or max(1, dims // 2), dims)
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    blocks = -(-n // query_block)
    paths = []
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toArrow().combine_chunks()
        if not len(block):
            continue
        ids = block["id"].to_numpy()
        values = matrix_of(block["v"].combine_chunks() if isinstance(block["v"], pa.ChunkedArray) else block["v"], dims, scale)

        def work(it: Iterator[pa.RecordBatch], ids=ids, values=values) -> Iterator[pa.RecordBatch]:
            search = Searcher(ids, values, basis, k, lead)
            for batch in it:
                for lo in range(0, batch.num_rows, SORTED_ROWS):
                    part = batch.slice(lo, SORTED_ROWS)
                    search.see(part.column(0).to_numpy(), matrix_of(part.column(1), dims, scale))
            yield search.rows(schema)

        paths.append(scratch_path(spark, f"topk-{b}"))
        vectors.mapInArrow(work, ddl).write.parquet(paths[-1])
    found = spark.read.schema(ddl).parquet(*paths).distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""
