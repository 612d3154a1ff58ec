"""The corpus pipeline: quality, repeated lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import quality as quality_model
from lectern.llm.decontamination import without_leaks
from lectern.llm.line_windows import drop_repeated_lines
from lectern.llm.packing import pack_by_cost
from lectern.llm.simhash import without_near_copies
from lectern.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted to these documents, does not reject."""
    docs = docs.select(*COLUMNS)
    model = quality_model.fit(docs)
    return quality_model.scored(docs, model).where("quality_keep").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of windows of three lines; ``n_chars`` follows the text.

    A document that loses all its lines stays with an empty text, and goes as a near copy.
    """
    found = drop_repeated_lines(docs.select(*COLUMNS), size=3)
    return found.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near copies (three-word shingles, up to three bits) the document with the smallest id."""
    return without_near_copies(docs.select(*COLUMNS), size=3, within=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents that are left, in sequences of 1,024 tokens."""
    return pack_by_cost(docs.select(*COLUMNS), capacity=1024, end=0)


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# Fitted models, fingerprints and packing have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
