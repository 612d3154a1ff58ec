"""Chat requests: who answers, and with what."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def route_conversations(turns: DataFrame, open_model: str) -> DataFrame:
    """One row per conversation: ``conv_id, n_messages, use_retrieval, llm, query``.

    A single message is a query: retrieved for and left to the router (``llm``
    NULL). Longer conversations go to the open model without retrieval. Only
    counts and one text are aggregated, so no conversation is gathered.
    """
    single = F.col("n_messages") == 1
    return (
        turns.groupBy("conv_id")
        .agg(F.count("*").alias("n_messages"), F.min_by("text", "turn").alias("_first"))
        .select(
            "conv_id",
            "n_messages",
            single.alias("use_retrieval"),
            F.when(~single, open_model).alias("llm"),
            F.when(single, F.col("_first")).alias("query"),
        )
    )


def conversation_messages(turns: DataFrame) -> DataFrame:
    """``(conv_id, messages)``: all messages in order, as one request to a model holds them."""
    gathered = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("_m")
    )
    return gathered.select(
        "conv_id", F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages")
    )
