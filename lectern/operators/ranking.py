"""Exact ranks over whole tables and hot groups, without one task per group.

A rank is the number of rows in earlier buckets plus the rank inside the own
bucket. Buckets follow the order wanted, so only their counts (a small table)
are summed serially and no window ever holds more than one bucket.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash prefix used as bucket: 16**3 = 4096 buckets per group.
HASH_PREFIX = 3


def ranked_by_bucket(df: DataFrame, bucket: str, order_by: list, groups: list[str] | None = None) -> DataFrame:
    """Adds ``_rank`` (from 1) within ``groups`` and ``_total``, the group's size.

    ``bucket`` must not fall when ``order_by`` rises.
    """
    # One struct as key: its fields may be NULL and still match.
    keyed = df.withColumn("_key", F.struct(*(groups or []), bucket))
    counts = keyed.groupBy("_key").agg(F.count("*").alias("_n"))
    group = Window.partitionBy(*[F.col(f"_key.{g}") for g in groups or []])
    earlier = group.orderBy(F.col(f"_key.{bucket}")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_key",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("_total"),
    )
    within = Window.partitionBy("_key").orderBy(*order_by)
    return (
        keyed.withColumn("_at", F.row_number().over(within))
        .join(offsets, "_key")
        .withColumn("_rank", F.col("_before") + F.col("_at"))
        .drop("_at", "_before", "_key")
    )


def hash_order(*columns: Column | str) -> Column:
    """A hash that SQL engines agree on, for orders that only need to be fixed."""
    return F.md5(F.concat_ws("#", *columns))


def with_ordinal(df: DataFrame, key: str, buckets: int = 1024) -> DataFrame:
    """Adds the 0-based position ``pos`` and the row count ``n_rows``, by ascending ``key``.

    Bucket borders are approximate quantiles of the key; the ranks are exact
    wherever the borders lie.
    """
    numeric = df.withColumn("_key", F.col(key).cast("double"))
    probabilities = [i / buckets for i in range(1, buckets)]
    borders = sorted(set(numeric.approxQuantile("_key", probabilities, 0.5 / buckets)))
    splits = [float("-inf"), *borders, float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="_key", outputCol="_bucket").transform(numeric)
    return (
        ranked_by_bucket(bucketed, "_bucket", [key])
        .withColumn("pos", F.col("_rank") - 1)
        .withColumnRenamed("_total", "n_rows")
        .drop("_key", "_bucket", "_rank")
    )


def assign_chunk_id(chunks: DataFrame, keys: list[str], prefix: int = HASH_PREFIX) -> DataFrame:
    """Adds dense ids from 1 in an order fixed by the rows' keys."""
    hashed = chunks.withColumn("_hash", hash_order(*keys)).withColumn("_bucket", F.substring("_hash", 1, prefix))
    return (
        ranked_by_bucket(hashed, "_bucket", ["_hash", *keys])
        .withColumnRenamed("_rank", "chunk_id")
        .drop("_hash", "_bucket", "_total")
    )


def hashed_chunk_id(*keys: Column | str) -> Column:
    """Ids that need no count and no shuffle; not dense."""
    return F.xxhash64(*keys)


def num_samples_limit(df: DataFrame, n: int | None, key: str = "pos") -> DataFrame:
    """The first ``n`` rows by ``key``; all when ``n`` is None."""
    return df if n is None else df.orderBy(key).limit(n)


def split_prefix(df: DataFrame, key: str, share: float = 0.8) -> DataFrame:
    """Adds ``part``: ``train`` for the first ``floor(share * n)`` rows by ``key``, else ``validation``."""
    placed = with_ordinal(df, key)
    return placed.withColumn(
        "part", F.when(F.col("pos") < F.floor(F.lit(share) * F.col("n_rows")), "train").otherwise("validation")
    ).drop("pos", "n_rows")


def split_stratified(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 1234) -> DataFrame:
    """Adds ``part``: each label gives ``ceil(test_share * n)`` rows to ``test`` by seeded hash."""
    hashed = df.withColumn("_hash", hash_order(F.col(key).cast("string"), F.lit(str(seed))))
    hashed = hashed.withColumn("_bucket", F.substring("_hash", 1, HASH_PREFIX))
    placed = ranked_by_bucket(hashed, "_bucket", ["_hash", key], groups=[label])
    return placed.withColumn(
        "part", F.when(F.col("_rank") <= F.ceil(F.lit(test_share) * F.col("_total")), "test").otherwise("train")
    ).drop("_hash", "_bucket", "_rank", "_total")
