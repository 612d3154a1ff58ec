"""Classification, routing and ranking metrics from prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.joins import broadcast_if_small


def tag_counts(df: DataFrame, tag: str = "tag") -> DataFrame:
    """Rows per label."""
    return df.groupBy(tag).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Long form: ``(actual, predicted, n)``."""
    return df.groupBy(actual, predicted).agg(F.count("*").alias("n"))


def confusion_pivot(df: DataFrame, labels: list[str], actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row per actual label, one column per predicted label, zeros filled."""
    return df.groupBy(actual).pivot(predicted, labels).count().na.fill(0)


def class_prf(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """``(label, support, precision, recall, f1)`` per class; empty ratios are 0."""
    zero = F.lit(0).cast("bigint")
    agree = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(zero)
    sides = F.array(
        F.struct(F.col(actual).alias("label"), F.col("n").alias("support"), agree.alias("hits"), zero.alias("called")),
        F.struct(F.col(predicted).alias("label"), zero.alias("support"), zero.alias("hits"), F.col("n").alias("called")),
    )
    counts = (
        confusion_matrix(df, actual, predicted)
        .select(F.inline(sides))
        .groupBy("label")
        .agg(F.sum("support").alias("support"), F.sum("hits").alias("hits"), F.sum("called").alias("called"))
    )
    precision = F.coalesce(F.try_divide("hits", "called"), F.lit(0.0))
    recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
    rated = counts.select("label", "support", precision.alias("precision"), recall.alias("recall"))
    f1 = F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return rated.withColumn("f1", F.coalesce(f1, F.lit(0.0)))


def weighted_prf(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """One row ``(precision, recall, f1, num_samples)``, classes weighted by support."""
    total = F.sum("support")
    return class_prf(df, actual, predicted).agg(
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in ("precision", "recall", "f1")],
        total.cast("double").alias("num_samples"),
    )


def routing_summary(df: DataFrame, predicted: str = "predicted", score: str = "score") -> DataFrame:
    """``(predicted, n, share, mean_score)``: how many go to each model and how they score."""
    routed = df.groupBy(predicted).agg(F.count("*").alias("n"), F.avg(score).alias("mean_score"))
    everything = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return routed.select(predicted, "n", (F.col("n") / everything).alias("share"), "mean_score")


def ir_metrics(ranked: DataFrame, relevant: DataFrame, cutoffs: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """Long form ``(metric, value)``: means over the questions that have a relevant document.

    ``ranked`` is ``(qid, pos, doc_id)`` down to rank 100, ``relevant`` is
    ``(qid, doc_id)``. The relevant side, which may be long, is only counted and
    probed.
    """
    sizes = relevant.groupBy("qid").agg(F.count("*").alias("n_relevant"))
    listed = ranked.where("pos < 100").select("qid", "pos", "doc_id")
    hits = relevant.join(broadcast_if_small(listed, settle="ranked"), ["qid", "doc_id"]).select("qid", "pos")

    ordered = Window.partitionBy("qid").orderBy("pos")
    hits = hits.withColumn("nth", F.row_number().over(ordered))
    per_question = hits.groupBy("qid").agg(
        *[F.count(F.when(F.col("pos") < k, 1)).alias(f"h{k}") for k in cutoffs],
        F.min(F.when(F.col("pos") < 10, F.col("pos"))).alias("first"),
        F.sum(F.when(F.col("pos") < 10, 1 / F.log2(F.col("pos") + 2))).alias("dcg"),
        F.sum(F.col("nth") / (F.col("pos") + 1)).alias("ap"),
    )
    ideal = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), F.least(F.col("n_relevant"), F.lit(10)) - 1),
        F.lit(0.0),
        lambda a, i: a + 1 / F.log2(i + 2),
    )
    rated = sizes.join(per_question, "qid", "left").na.fill(0, [f"h{k}" for k in cutoffs])

    def mean(value: Column, name: str) -> Column:
        return F.avg(F.coalesce(value, F.lit(0.0))).alias(name)

    wide = rated.agg(
        *[mean(F.when(F.col(f"h{k}") > 0, 1.0), f"accuracy@{k}") for k in cutoffs],
        *[mean(F.col(f"h{k}") / F.lit(k), f"precision@{k}") for k in cutoffs],
        *[mean(F.col(f"h{k}") / F.col("n_relevant"), f"recall@{k}") for k in cutoffs],
        mean(1 / (F.col("first") + 1), "mrr@10"),
        mean(F.col("dcg") / ideal, "ndcg@10"),
        mean(F.col("ap") / F.least(F.col("n_relevant"), F.lit(100)), "map@100"),
    )
    entries = [F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in wide.columns]
    return wide.select(F.inline(F.array(*entries)))
