"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize


def _signature(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v") % 1000003)).first())


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node of the links: root is the smallest node that can be reached.

    Rounds of large-star and small-star turn every component into a star around
    its smallest node; each round is written to the shared folder, so that the
    lineage stays short and lost executors cost one round. Nodes are longs;
    links of a node with itself, repeated links and an empty table are fine.
    """
    pairs = links.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v").distinct()
    pairs = materialize(pairs, "links")
    before = _signature(pairs)
    while before[0]:
        pairs = materialize(_small_star(_large_star(pairs)), "links")
        after = _signature(pairs)
        if after == before:
            break
        before = after
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(pairs.select(F.col("v"), F.col("v")).distinct())
