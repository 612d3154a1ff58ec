"""The chunk index as a Parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import path_exists


def checked_index(chunks: DataFrame, dim: int) -> DataFrame:
    """``(id, text, source, embedding)``; a missing text or source or a wrong length fails the write."""

    def required(name):
        return F.when(F.col(name).isNotNull(), F.col(name)).otherwise(F.raise_error(F.lit(f"{name} is missing")))

    fits = F.col("embedding").isNull() | (F.size("embedding") == dim)
    vector = F.when(fits, F.col("embedding")).otherwise(F.raise_error(F.lit(f"embedding is not of length {dim}")))
    return chunks.select(
        "id", required("text").alias("text"), required("source").alias("source"),
        vector.alias("embedding", metadata=chunks.schema["embedding"].metadata),
    )


def write_index(chunks: DataFrame, path: str, dim: int) -> None:
    """Replace the index at ``path``; a failed write leaves no finished table."""
    checked_index(chunks, dim).write.mode("overwrite").parquet(path)


def reset_index(spark: SparkSession, path: str, dim: int) -> None:
    """An empty index at ``path``."""
    empty = spark.createDataFrame([], "id bigint, text string, source string, embedding array<float>")
    write_index(empty, path, dim)


def write_index_jdbc(chunks: DataFrame, url: str, table: str, **options) -> None:
    """Store the index in a database; the vector goes as its text form."""
    vector = F.concat(F.lit("["), F.array_join(F.col("embedding").cast("array<string>"), ","), F.lit("]"))
    rows = chunks.select("id", "text", "source", vector.alias("embedding"))
    rows.write.mode("append").options(**options).jdbc(url, table)


def read_index_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``(id, text, source)``; the vectors are not read."""
    return spark.read.parquet(path).select("id", "text", "source")


def index_path(root: str, model: str, chunk_size: int, chunk_overlap: int) -> str:
    """``root/{model}_{size}_{overlap}`` with the model's short name."""
    return f"{root.rstrip('/')}/{model.split('/')[-1]}_{chunk_size}_{chunk_overlap}"


def load_or_build_index(
    spark: SparkSession,
    root: str,
    model: str,
    dim: int,
    chunk_size: int,
    chunk_overlap: int,
    build: Callable[[], DataFrame],
) -> DataFrame:
    """The stored index's ``(id, text, source)``; built and stored first when there is none."""
    path = index_path(root, model, chunk_size, chunk_overlap)
    if not path_exists(spark, path):
        write_index(build(), path, dim)
    return read_index_chunks(spark, path)


def count_rows(**tables: DataFrame) -> DataFrame:
    """``(name, n)`` of the given tables."""
    parts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, t in tables.items()]
    counted = parts[0]
    for part in parts[1:]:
        counted = counted.unionByName(part)
    return counted
