"""Positional merge of semantic and lexical results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small, has_at_most
from lectern.session import materialize


def hybrid_merge(semantic: DataFrame, lexical: DataFrame, lexical_k: int) -> DataFrame:
    """``(qid, pos, doc_id, origin)``: lexical rows put in at position ``lexical_k``.

    Appended when there are fewer semantic rows; duplicates are kept.
    """
    rows = semantic.select("qid", "pos", "doc_id", F.lit("semantic").alias("origin")).unionByName(
        lexical.select("qid", "pos", "doc_id", F.lit("lexical").alias("origin"))
    )
    question = Window.partitionBy("qid")
    from_lexical = F.col("origin") == "lexical"
    n_lexical = F.count(F.when(from_lexical, 1)).over(question)
    n_semantic = F.count(F.when(~from_lexical, 1)).over(question)
    at = F.least(F.lit(lexical_k).cast("bigint"), n_semantic)
    merged = (
        F.when(from_lexical, at + F.col("pos"))
        .when(F.col("pos") < at, F.col("pos"))
        .otherwise(F.col("pos") + n_lexical)
    )
    return rows.select("qid", merged.cast("int").alias("pos"), "doc_id", "origin")


def attach_documents(results: DataFrame, documents: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Result rows with their documents' columns.

    The corpus stays unshuffled while results are few; else only documents that
    occur in some result are shuffled.
    """
    settled = materialize(results, "results")
    if has_at_most(settled, max_rows):
        return documents.join(F.broadcast(settled), "doc_id")
    near = documents.join(broadcast_if_small(settled.select("doc_id").distinct(), 4 * max_rows), "doc_id", "left_semi")
    return near.join(settled, "doc_id")
