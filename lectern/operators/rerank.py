"""Reranking by a predicted tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OTHER = "other"


def softmax(logits: Column) -> Column:
    """Array of logits to probabilities."""
    shifted = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, x: a + x)
    return F.transform(shifted, lambda x: x / total)


def threshold_label(labels: Column, probabilities: Column, threshold: float = 0.2, other: str = OTHER) -> Column:
    """The first most probable label when it reaches the threshold, else ``other``."""
    best = F.array_max(probabilities)
    label = F.get(labels, F.array_position(probabilities, best).cast("int") - 1)
    return F.when(best >= threshold, label).otherwise(other)


def keep_tags_else_other(tag: Column, keep: list[str], other: str = OTHER) -> Column:
    """Tags outside the list become ``other``."""
    return F.when(tag.isin(keep), tag).otherwise(other)


def rerank_by_tag(contexts: DataFrame, predictions: DataFrame, tag: str = "tag") -> DataFrame:
    """``pos`` renewed: rows with the predicted tag first, otherwise in order.

    ``predictions`` has ``qid, predicted_tag``; nothing moves for ``other``.
    """
    predicted = F.coalesce("predicted_tag", F.lit(OTHER))
    misses = (predicted != OTHER) & (F.coalesce(F.col(tag), F.lit("")) != predicted)
    order = Window.partitionBy("qid").orderBy(misses, "pos")
    return (
        contexts.join(predictions.select("qid", "predicted_tag"), "qid", "left")
        .withColumn("pos", F.row_number().over(order) - 1)
        .drop("predicted_tag")
    )


def rerank_truncate(contexts: DataFrame, rerank_k: int) -> DataFrame:
    """The first ``rerank_k`` rows of each question."""
    return contexts.where(F.col("pos") < rerank_k)
