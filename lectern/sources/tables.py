"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, path: str, spread_by: str | None = None) -> DataFrame:
    """A Parquet table; rows are spread by key only when it has fewer splits than the cluster has cores.

    A table of cluster size has far more splits than cores and is read in place.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread_by and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores, spread_by)
    return df
