"""Exact cosine search for many questions at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.block_topk import score_queries, slices, topk
from lectern.operators.embedding import require_same_encoder

# Ranks below any real score: a zero vector has no angle, a missing one comes last.
NO_ANGLE = -1e6
NO_VECTOR = -2e6


def matrix_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows (zeros where missing) and the mask of missing ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    dims = np.unique(lengths[lengths > 0])
    if len(dims) > 1:
        raise ValueError(f"vectors of different lengths: {dims.tolist()}")
    dim = int(dims[0]) if len(dims) else 0
    matrix = np.zeros((len(column), dim))
    if dim:
        matrix[lengths > 0] = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    return matrix, lengths == 0


def cosine_scorer(queries: pa.Table):
    """Scores minus the cosine distance of a batch's ``embedding`` to every query."""
    wanted, _ = matrix_of(queries.column("embedding"))
    wanted_norms = np.linalg.norm(wanted, axis=1)

    def score(batch: pa.RecordBatch):
        vectors, missing = matrix_of(batch.column("embedding"))
        ids = batch.column("doc_id").to_numpy()
        if vectors.shape[1] not in (0, wanted.shape[1]) and wanted.shape[1]:
            raise ValueError(f"index has {vectors.shape[1]} dimensions, questions {wanted.shape[1]}")
        norms = np.linalg.norm(vectors, axis=1)
        for start, end in slices(len(ids), len(wanted)):
            dots = wanted @ vectors[start:end].T if vectors.shape[1] == wanted.shape[1] else np.zeros((len(wanted), end - start))
            scale = wanted_norms[:, None] * norms[None, start:end]
            scores = np.divide(dots, scale, out=np.full(dots.shape, NO_ANGLE), where=scale > 0)
            scores = np.where(scale > 0, scores - 1.0, scores)
            scores[:, missing[start:end]] = NO_VECTOR
            yield ids[start:end], scores

    return score


def semantic_topk(index: DataFrame, queries: DataFrame, k: int, **ways) -> DataFrame:
    """``(qid, pos, doc_id, dist)``: the ``k`` nearest by cosine distance, ties by id.

    ``index`` has ``doc_id, embedding``, ``queries`` has ``qid, embedding``.
    Zero vectors, then missing ones, come after all others with a NULL distance.
    Vectors that name two different encoders raise an error.
    """
    require_same_encoder(index, queries)
    ranked = topk(index.select("doc_id", "embedding"), queries.select("qid", "embedding"), cosine_scorer, k, **ways)
    distance = F.when(F.col("score") > NO_ANGLE, 0.0 - F.col("score"))
    return ranked.select("qid", "pos", "doc_id", distance.alias("dist"))


def distance_summary(index: DataFrame, queries: DataFrame, **ways) -> DataFrame:
    """``(qid, n, mean_dist, min_dist, max_dist)`` of each query against every vector that has an angle.

    Distances are summed up inside each task; no query-vector pair leaves it.
    """
    schema = "qid bigint, n bigint, total double, low double, high double"

    def reduce(batches, score, qids):
        n, total = np.zeros(len(qids), dtype=np.int64), np.zeros(len(qids))
        low, high = np.full(len(qids), np.inf), np.full(len(qids), -np.inf)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for _, scores in score(batch):
                real = scores > NO_ANGLE
                distances = np.where(real, -scores, 0.0)
                n += real.sum(axis=1)
                total += distances.sum(axis=1)
                low = np.minimum(low, np.where(real, distances, np.inf).min(axis=1))
                high = np.maximum(high, np.where(real, distances, -np.inf).max(axis=1))
        columns = {"qid": pa.array(qids, pa.int64()), "n": n, "total": total, "low": low, "high": high}
        return pa.record_batch({name: pa.array(values) for name, values in columns.items()})

    partial = score_queries(
        index.select("doc_id", "embedding"), queries.select("qid", "embedding"), cosine_scorer, reduce, schema, **ways
    )
    return partial.groupBy("qid").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum("total"), F.sum("n")).alias("mean_dist"),
        F.min("low").alias("min_dist"),
        F.max("high").alias("max_dist"),
    )
