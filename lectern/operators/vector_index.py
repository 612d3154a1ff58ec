"""Exact cosine search over a stored table of vectors, in files by cluster.

Vectors of unit length are stored in the folder of their nearest centroid, beside a
table of centroids with the radius of each cluster. By the triangle inequality
no vector of a cluster is nearer to a query than the distance to its centroid less
the radius, so a search reads the nearest clusters first and then those alone that
can still hold one of the best. Vectors are never shuffled for a search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.block_topk import TOPK_SCHEMA, best_hits, query_blocks, ranked, slices
from lectern.operators.embedding import encoder_of, require_same_encoder, with_encoder
from lectern.operators.semantic import NO_ANGLE, NO_VECTOR, matrix_of
from lectern.session import path_exists, scratch_path

# Most clusters, and most vectors that the centroids are fitted to (all vectors are stored).
MOST_CLUSTERS, SAMPLE = 1024, 20_000
# Rounds of moving the centroids.
ROUNDS = 8
# Vectors of a cluster that one task writes.
ROWS_A_FILE = 500_000
# The folder of vectors without an angle (zero or missing).
NO_CLUSTER = -1


@dataclass
class VectorIndex:
    """``vectors``: doc_id, embedding, cluster (a folder each). ``centroids, radii, counts`` by cluster; ``odd`` vectors have no angle."""

    vectors: DataFrame
    centroids: np.ndarray
    radii: np.ndarray
    counts: np.ndarray
    odd: int


def unit(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length one, and which rows have a length."""
    norms = np.linalg.norm(matrix, axis=1)
    return matrix / np.where(norms > 0, norms, 1)[:, None], norms > 0


def gaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def fitted_centroids(sample: np.ndarray, clusters: int, seed: int = 3) -> np.ndarray:
    """Unit vectors in the middle of their nearest sampled vectors."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(sample, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:clusters]]
    for _ in range(ROUNDS):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        moved, some = unit(sums)
        centres = np.where(some[:, None], moved, centres)
    return centres


def build_vector_index(vectors: DataFrame, path: str | None = None, clusters: int | None = None) -> VectorIndex:
    """Store ``vectors`` (``doc_id, embedding``) by cluster; the number of clusters is the root of that of the vectors, at most MOST_CLUSTERS.

    The centroids are fitted to a bounded sample by a hash of the id; radii and
    counts are those of all vectors. Rows are spread over more files where a
    cluster has many.
    """
    spark = vectors.sparkSession
    path = path or scratch_path(spark, "vector-index")
    rows = vectors.select("doc_id", "embedding")
    n = rows.count()
    clusters = clusters or max(1, min(MOST_CLUSTERS, math.isqrt(n)))
    share = min(1.0, 2 * SAMPLE / max(1, n))
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    some = rows.where(rank < int(share * (1 << 30))).orderBy(rank, "doc_id").limit(SAMPLE)
    matrix, _ = matrix_of(some.select("embedding").toArrow()["embedding"])
    sample, real = unit(matrix)
    centres = fitted_centroids(sample[real], clusters) if real.any() else np.zeros((0, matrix.shape[1]))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            own, _ = matrix_of(batch["embedding"])
            cluster, distance = np.full(batch.num_rows, NO_CLUSTER, np.int32), np.zeros(batch.num_rows)
            if len(centres) and own.shape[1]:
                if own.shape[1] != centres.shape[1]:
                    raise ValueError(f"vectors of {own.shape[1]} and {centres.shape[1]} dimensions")
                made, has = unit(own)
                for start, end in slices(batch.num_rows, len(centres)):
                    apart = gaps(made[start:end], centres)
                    cluster[start:end] = np.where(has[start:end], apart.argmin(axis=1), NO_CLUSTER)
                    distance[start:end] = apart.min(axis=1)
            yield pa.record_batch({"doc_id": batch["doc_id"], "embedding": batch["embedding"], "cluster": pa.array(cluster), "gap": pa.array(distance)})

    kind = rows.schema["embedding"].dataType.simpleString()
    placed = rows.mapInArrow(place, f"doc_id long, embedding {kind}, cluster int, gap double")
    files = max(1, math.ceil(n / ROWS_A_FILE))
    spread = placed.repartition(max(spark.sparkContext.defaultParallelism, files), "cluster", F.pmod(F.xxhash64("doc_id"), F.lit(files)))
    spread.write.partitionBy("cluster").parquet(f"{path}/vectors")
    stored = spark.read.schema(placed.schema).parquet(f"{path}/vectors")
    sizes = stored.groupBy("cluster").agg(F.max("gap").alias("radius"), F.count("*").alias("n"))
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)] + [(NO_CLUSTER, [])], "cluster int, centroid array<double>")
    # The small table comes last: without it the index does not count as written.
    known = table.join(sizes, "cluster", "left").withColumns({"encoder": F.lit(encoder_of(rows)).cast("string"), "kind": F.lit(kind)})
    known.coalesce(1).write.parquet(f"{path}/centroids")
    return read_vector_index(spark, path)


def read_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    """Open a stored index."""
    if not path_exists(spark, f"{path}/centroids"):
        raise FileNotFoundError(path)
    found = spark.read.parquet(f"{path}/centroids").orderBy("cluster").collect()
    own = [r for r in found if r["cluster"] != NO_CLUSTER]
    odd = sum(r["n"] or 0 for r in found if r["cluster"] == NO_CLUSTER)
    radii, counts = np.array([r["radius"] or 0.0 for r in own]), np.array([r["n"] or 0 for r in own], np.int64)
    vectors = spark.read.schema(f"doc_id long, embedding {found[0]['kind']}, gap double, cluster int").parquet(f"{path}/vectors")
    return VectorIndex(with_encoder(vectors, found[0]["encoder"]), np.array([r["centroid"] for r in own]), radii, counts, odd)


def read_clusters(index: VectorIndex, table: pa.Table, needed: np.ndarray, k: int) -> DataFrame:
    """Each task's best ``k`` vectors of each query among its ``needed`` clusters (queries x clusters, the last one for odd vectors)."""
    qids = table["qid"].to_numpy()
    wanted, has = unit(matrix_of(table["embedding"])[0])
    asked = np.flatnonzero(needed.any(axis=0)).tolist()
    last = needed.shape[1] - 1
    folders = [NO_CLUSTER if c == last else c for c in asked]
    keep = best_hits(k)

    def hits(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix, missing = matrix_of(batch["embedding"])
            made, real = unit(matrix)
            ids, cluster = batch["doc_id"].to_numpy(), batch["cluster"].to_numpy()
            for c in np.unique(cluster):
                who, here = np.flatnonzero(needed[:, c]), np.flatnonzero(cluster == c)
                if len(who) and made.shape[1] not in (0, wanted.shape[1]):
                    raise ValueError(f"index has {made.shape[1]} dimensions, questions {wanted.shape[1]}")
                for start, end in slices(len(here), max(1, len(who))):
                    at = here[start:end]
                    scores = wanted[who] @ made[at].T - 1 if made.shape[1] else np.zeros((len(who), len(at)))
                    scores = np.where(has[who][:, None] & real[at][None, :], scores, NO_ANGLE)
                    scores[:, missing[at]] = NO_VECTOR
                    order = np.argsort(ids[at], kind="stable")
                    scores, own = scores[:, order], ids[at][order]
                    first = np.argsort(-np.round(scores, 9), axis=1, kind="stable")[:, :k]
                    q = np.repeat(qids[who], first.shape[1])
                    yield q, own[first].ravel(), np.take_along_axis(scores, first, axis=1).ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from keep(hits(batches))

    chosen = index.vectors.where(F.col("cluster").isin(folders)) if folders else index.vectors.limit(0)
    return chosen.select("doc_id", "embedding", "cluster").mapInArrow(run, TOPK_SCHEMA)


def bounds(index: VectorIndex, table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Least possible distance of each query to each cluster's vectors, and which queries have an angle."""
    wanted, has = unit(matrix_of(table["embedding"])[0])
    if not len(index.centroids) or wanted.shape[1] != index.centroids.shape[1]:
        return np.zeros((len(wanted), len(index.centroids))), has
    return np.maximum(gaps(wanted, index.centroids) - index.radii[None, :] - 1e-7, 0), has


def first_clusters(index: VectorIndex, low: np.ndarray, has: np.ndarray, k: int) -> np.ndarray:
    """The clusters read first: those of the least bounds that hold ``k`` vectors together; all for queries without an angle or if there are fewer."""
    needed = np.zeros((len(low), low.shape[1] + 1), bool)
    enough = index.counts.sum() >= k
    order = np.argsort(low, axis=1, kind="stable")
    before = np.cumsum(index.counts[order], axis=1) - index.counts[order]
    rows, places = np.nonzero(before < k)
    needed[rows, order[rows, places]] = True
    needed[~has if enough else slice(None)] = True
    return needed


def semantic_search(index: VectorIndex, queries: DataFrame, k: int, report: list | None = None) -> DataFrame:
    """``(qid, pos, doc_id, dist)``: the ``k`` nearest by cosine distance, ties by id; rows as ``semantic.semantic_topk`` gives them.

    ``report`` gets ``(queries, clusters, cluster reads)`` of each block of queries,
    a read being one query's interest in one cluster.
    """
    require_same_encoder(index.vectors, queries)
    spark = queries.sparkSession
    parts = []
    for table in query_blocks(queries.select("qid", "embedding")) if k > 0 else ():
        low, has = bounds(index, table)
        needed = first_clusters(index, low, has, k)
        near = ranked(read_clusters(index, table, needed, k), k).toArrow()
        # The k-th best so far, as a distance of unit vectors; no bound for queries that have fewer.
        worst = np.full(len(low), np.inf)
        at = {q: i for i, q in enumerate(table["qid"].to_pylist())}
        for qid, pos, score in zip(*(near[c].to_pylist() for c in ("qid", "pos", "score"))):
            if pos == k - 1 and score > NO_ANGLE:
                worst[at[qid]] = math.sqrt(max(0.0, -2 * score)) + 1e-6
        more = np.concatenate([low <= worst[:, None], np.zeros((len(low), 1), bool)], axis=1) & ~needed
        if report is not None:
            report.append((len(low), low.shape[1], int((needed | more)[:, :-1].sum())))
        parts.append(spark.createDataFrame(near.select(["qid", "doc_id", "score", "rank_score"])))
        if more.any():
            parts.append(read_clusters(index, table, more, k))
    if not parts:
        return spark.createDataFrame([], "qid bigint, pos int, doc_id bigint, dist double")
    partial = parts[0]
    for part in parts[1:]:
        partial = partial.unionByName(part)
    distance = F.when(F.col("score") > NO_ANGLE, 0.0 - F.col("score"))
    return ranked(partial, k).select("qid", "pos", "doc_id", distance.alias("dist"))
