"""Top-k of every query over a corpus, without forming query-document pairs.

A scorer turns one Arrow batch of the corpus into a small dense block of scores;
each task keeps only ``k`` rows per query, and one window merges the tasks' lists.

Queries travel with the function: the corpus is scanned unshuffled, once for each
block of queries (their number and size are checked first).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.batches import pieces
from lectern.session import materialize

# Most queries, and most vector entries of them, that travel with the function at once.
MAX_CARRIED_QUERIES = 2048
MAX_CARRIED_ENTRIES = 4_000_000
# The tasks' lists of a query are merged in this many groups first.
TASK_GROUPS = 64
# Score cells held at once by a task (8 bytes each, in some ten arrays).
CELLS = 500_000
# Scores are ranked by this many digits, so that equal rows tie in any summing order.
RANK_DIGITS = 9

TOPK_SCHEMA = "qid bigint, doc_id bigint, score double, rank_score double"

Scorer = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]]


def _block_best(ranks: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest values of each row, the first of equals."""
    n = ranks.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), ranks.shape)
    cut = np.partition(ranks, n - k, axis=1)[:, n - k, None]
    above = ranks > cut
    level = ranks == cut
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (level & (level.cumsum(axis=1) <= room)))[1].reshape(-1, k)


def _task_best(batches, scorer: Scorer, n_queries: int, k: int) -> dict[str, np.ndarray]:
    """Each query's best rows of the task: document, exact score and the score it ranks by."""
    best = {"doc_id": np.empty((n_queries, 0), np.int64), "score": np.empty((n_queries, 0)), "rank_score": np.empty((n_queries, 0))}
    for batch in batches:
        if batch.num_rows == 0:
            continue
        for ids, scores in scorer(batch):
            order = np.argsort(ids, kind="stable")
            ids, scores = ids[order], scores[:, order]
            ranks = np.round(scores, RANK_DIGITS)
            columns = _block_best(ranks, k)
            found = {
                "doc_id": ids[columns],
                "score": np.take_along_axis(scores, columns, axis=1),
                "rank_score": np.take_along_axis(ranks, columns, axis=1),
            }
            both = {name: np.concatenate([best[name], found[name]], axis=1) for name in best}
            first = np.lexsort((both["doc_id"], -both["rank_score"]), axis=-1)[:, :k]
            best = {name: np.take_along_axis(values, first, axis=1) for name, values in both.items()}
    return best


def _topk_rows(qids: np.ndarray, best: dict[str, np.ndarray]) -> pa.RecordBatch:
    each = best["doc_id"].shape[1]
    return pa.record_batch({"qid": pa.array(np.repeat(qids, each)), **{n: pa.array(v.ravel()) for n, v in best.items()}})


def slices(n_rows: int, cells_per_row: int) -> Iterator[tuple[int, int]]:
    """Row ranges whose score blocks stay within ``CELLS``."""
    step = max(1, CELLS // max(1, cells_per_row))
    for start in range(0, n_rows, step):
        yield start, min(n_rows, start + step)


def scan_corpus(corpus: DataFrame, table: pa.Table, make_scorer, reduce, schema: str) -> DataFrame:
    """One unshuffled corpus pass; ``reduce(batches, scorer, qids)`` gives each task's result."""
    qids = table.column("qid").to_numpy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(qids):
            yield reduce((piece for batch in batches for piece in pieces(batch)), make_scorer(table), qids)

    return corpus.mapInArrow(run, schema)


def query_blocks(queries: DataFrame, max_queries: int = MAX_CARRIED_QUERIES) -> Iterator[pa.Table]:
    """All queries (``qid`` and one array column) in tables that may travel with a function.

    Their rows and entries are counted before any of them is fetched; there is always a table.
    """
    queries = materialize(queries, "queries")
    entries = F.sum(F.size(next(c for c in queries.columns if c != "qid")))
    n_queries, n_entries = queries.agg(F.count("*"), F.coalesce(entries, F.lit(0))).first()
    blocks = max(1, math.ceil(n_queries / max_queries), math.ceil(n_entries / MAX_CARRIED_ENTRIES))
    for block in range(blocks):
        yield queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == block).toArrow()


def score_queries(corpus: DataFrame, queries: DataFrame, make_scorer, reduce, schema: str, max_queries: int = MAX_CARRIED_QUERIES) -> DataFrame:
    """Partial results of all queries over all of the corpus: one unshuffled pass for each block of queries."""
    passes = [scan_corpus(corpus, table, make_scorer, reduce, schema) for table in query_blocks(queries, max_queries)]
    partial = passes[0]
    for more in passes[1:]:
        partial = partial.unionByName(more)
    return partial


def best_hits(k: int):
    """Reducer of ``(qid, doc_id, score)`` arrays: a task's best ``k`` of each query."""

    def reduce(hits):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0)]
        for q, d, s in hits:
            held = [np.concatenate(pair) for pair in zip(held, (q, d, s, np.round(s, RANK_DIGITS)))]
            order = np.lexsort((held[1], -held[3], held[0]))
            nth = np.arange(len(order)) - np.searchsorted(held[0][order], held[0][order])
            held = [h[order[nth < k]] for h in held]
        yield pa.record_batch(dict(zip(("qid", "doc_id", "score", "rank_score"), map(pa.array, held))))

    return reduce


def topk(corpus: DataFrame, queries: DataFrame, make_scorer, k: int, **ways) -> DataFrame:
    """``(qid, pos, doc_id, score)``: the ``k`` highest scores per query, ties by lowest id."""

    def reduce(batches, scorer, qids):
        return _topk_rows(qids, _task_best(batches, scorer, len(qids), k))

    if k <= 0:
        partial = corpus.sparkSession.createDataFrame([], TOPK_SCHEMA)
    else:
        partial = score_queries(corpus, queries, make_scorer, reduce, TOPK_SCHEMA, **ways)

    return ranked(partial, k).select("qid", "pos", "doc_id", "score")


def ranked(partial: DataFrame, k: int) -> DataFrame:
    """``qid, pos, doc_id, score, rank_score``: the best ``k`` of the tasks' lists, merged in two steps."""

    def keep_best(lists: DataFrame, *groups: str) -> DataFrame:
        order = Window.partitionBy(*groups).orderBy(F.col("rank_score").desc(), "doc_id")
        return lists.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= k)

    grouped = partial.withColumn("_tasks", F.spark_partition_id() % TASK_GROUPS)
    best = keep_best(keep_best(grouped, "qid", "_tasks"), "qid")
    return best.select("qid", (F.col("_rank") - 1).alias("pos"), "doc_id", "score", "rank_score")
