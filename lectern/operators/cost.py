"""Cost of experiments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import token_count

# Characters per word and tokens per word of retrieved context.
CHARS_PER_WORD = 5
TOKENS_PER_WORD = 4 / 3


def cost_analysis(results: DataFrame, configs: DataFrame, prices: DataFrame, tokens=token_count) -> DataFrame:
    """Tokens and cost per experiment.

    ``results``: experiment_name, question, generated_answer. ``configs``:
    experiment_name, chunk_size, num_chunks. ``prices``: model, prompt_price,
    sampled_price; an experiment is priced by its name and kept without a
    price, or without a config (its tokens of context are unknown then).
    Context is priced as full chunks, five characters to a word.
    """
    sums = results.groupBy("experiment_name").agg(
        F.count("*").alias("num_samples"),
        F.sum(tokens(F.col("question"))).alias("_question"),
        F.sum(tokens(F.col("generated_answer"))).alias("_sampled"),
    )
    priced = prices.withColumnRenamed("model", "experiment_name")
    context = (F.col("chunk_size") / CHARS_PER_WORD) * F.lit(TOKENS_PER_WORD) * F.col("num_chunks")
    prompt = F.col("_question") + context * F.col("num_samples")
    total = F.col("prompt_price") / 1e6 * F.col("_prompt") + F.col("sampled_price") / 1e6 * F.col("_sampled")
    return (
        sums.join(configs, "experiment_name", "left")
        .join(priced, "experiment_name", "left")
        .withColumn("_prompt", prompt)
        .select(
            "experiment_name",
            "num_samples",
            F.floor(F.col("_prompt") / F.col("num_samples")).alias("avg_prompt_tokens"),
            F.floor(F.col("_sampled") / F.col("num_samples")).alias("avg_sampled_tokens"),
            total.alias("total_cost"),
            (total / F.col("num_samples")).alias("avg_cost"),
        )
    )


def cost_multiplier(costs: DataFrame, chosen: str) -> DataFrame:
    """``(experiment_name, multiplier)``: average cost over the chosen experiment's."""
    base = F.max(F.when(F.col("experiment_name") == chosen, F.col("avg_cost"))).over(Window.partitionBy(F.lit(1)))
    return costs.select("experiment_name", F.try_divide(F.col("avg_cost"), base).alias("multiplier"))
