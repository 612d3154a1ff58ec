"""Scores of generated answers against references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.urls import strip_anchor


def join_refs_generated(references: DataFrame, generated: DataFrame) -> DataFrame:
    """References and the generated rows of the same ``pos``, with those of either side that have no partner.

    ``same_question`` is false for these too; ``question`` is the reference's
    where there is one.
    """
    left = references.withColumn("_in_r", F.lit(True))
    ours = generated.withColumnRenamed("question", "_question").withColumn("_in_g", F.lit(True))
    both = F.col("_in_r").isNotNull() & F.col("_in_g").isNotNull()
    return (
        left.join(ours, "pos", "full")
        .withColumn("same_question", both & F.col("question").eqNullSafe(F.col("_question")))
        .withColumn("question", F.when(F.col("_in_r"), F.col("question")).otherwise(F.col("_question")))
        .drop("_question", "_in_r", "_in_g")
    )


def alignment_report(references: DataFrame, generated: DataFrame) -> DataFrame:
    """One row with the counts of both sides, of unmatched rows and of differing questions."""
    left = references.select("pos", F.col("question").alias("_r"), F.lit(1).alias("_in_r"))
    right = generated.select("pos", F.col("question").alias("_g"), F.lit(1).alias("_in_g"))
    both = F.col("_in_r").isNotNull() & F.col("_in_g").isNotNull()
    return left.join(right, "pos", "full").agg(
        F.count("_in_r").alias("n_references"),
        F.count("_in_g").alias("n_generated"),
        F.count(F.when(~both, 1)).alias("n_unmatched"),
        F.count(F.when(both & ~F.col("_r").eqNullSafe(F.col("_g")), 1)).alias("n_differing"),
    )


def is_hit(reference_source: Column, sources: Column) -> Column:
    """True when a source lies on the reference page, or there is no reference page."""
    page = strip_anchor(F.coalesce(reference_source, F.lit("")))
    return (page == "") | F.coalesce(F.exists(sources, lambda s: strip_anchor(s) == page), F.lit(False))


def retrieval_score(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``retrieval_score``: share of hits among rows with ``source`` and ``sources``."""
    hit = is_hit(F.col("source"), F.col("sources"))
    return pairs.groupBy(*(by or [])).agg(
        F.avg(hit.cast("double")).alias("retrieval_score"), F.count("*").alias("n_questions")
    )


def retrieved_hit_semi(references: DataFrame, retrieved: DataFrame) -> DataFrame:
    """References ``(pos, source)`` whose page occurs among the rows ``(pos, source)`` retrieved for them."""
    pages = retrieved.select("pos", strip_anchor(F.col("source")).alias("_page"))
    return (
        references.withColumn("_page", strip_anchor(F.col("source"))).join(pages, ["pos", "_page"], "left_semi").drop("_page")
    )


def scored_with_reference(score: Column, reference_answer: Column) -> Column:
    """True when the score is not 0 and there is a reference answer."""
    return (score != 0) & (reference_answer != "")


def filter_scored_with_reference(df: DataFrame) -> DataFrame:
    """Rows that count for the quality score."""
    return df.where(scored_with_reference(F.col("score"), F.col("reference_answer")))


def filter_nonempty_response(df: DataFrame, column: str = "response") -> DataFrame:
    """Rows with a non-empty model response."""
    return df.where(F.col(column) != "")


def quality_score(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``quality_score`` (NULL without a counted row), counted and left-out rows."""
    counts = scored_with_reference(F.col("score"), F.col("reference_answer"))
    return df.groupBy(*(by or [])).agg(
        F.avg(F.when(counts, F.col("score"))).alias("quality_score"),
        F.count(F.when(counts, 1)).alias("n_scored"),
        F.count(F.when(~F.coalesce(counts, F.lit(False)), 1)).alias("n_left_out"),
    )


def mean_reference_score(df: DataFrame, score: str = "score") -> DataFrame:
    """Mean of the scores that can be read as a number and are not empty or 0."""
    number = F.col(score).cast("string").try_cast("double")
    return df.agg(F.avg(F.when(number != 0, number)).alias("mean_score"))


def experiment_scores(scores: DataFrame) -> DataFrame:
    """Name, retrieval and quality of each experiment, by name."""
    return scores.select("experiment_name", "retrieval_score", "quality_score").orderBy("experiment_name")


def top_experiments(scores: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` best by quality, then retrieval; a missing quality counts as the best."""
    order = [F.col("quality_score").desc_nulls_first(), F.col("retrieval_score").desc(), F.col("experiment_name")]
    return scores.orderBy(*order).limit(n)


def num_chunks_sweep(ranked: DataFrame, references: DataFrame, sizes: list[int]) -> DataFrame:
    """``(num_chunks, retrieval_score)``: one ranking cut at every size.

    ``ranked`` is ``(qid, pos, source)`` down to the largest size. The first hit
    of a question decides for all sizes, so nothing is ranked or joined twice.
    """
    page = strip_anchor(F.coalesce("source", F.lit("")))
    wanted = references.select("qid", page.alias("_page"))
    found = ranked.select("qid", "pos", strip_anchor(F.col("source")).alias("_page"))
    first = wanted.join(found, ["qid", "_page"]).groupBy("qid").agg(F.min("pos").alias("first"))
    reached = wanted.join(first, "qid", "left").withColumn("first", F.when(F.col("_page") == "", -1).otherwise(F.col("first")))
    wide = reached.agg(*[F.avg(F.coalesce(F.col("first") < n, F.lit(False)).cast("double")).alias(str(n)) for n in sizes])
    entries = [F.struct(F.lit(n).alias("num_chunks"), F.col(f"`{n}`").alias("retrieval_score")) for n in sizes]
    return wide.select(F.inline(F.array(*entries)))
