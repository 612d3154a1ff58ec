"""Model catalogues as small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Vector length of each embedding model.
DIMENSIONS = {
    "thenlper/gte-base": 768,
    "thenlper/gte-large": 1024,
    "BAAI/bge-large-en": 1024,
    "text-embedding-ada-002": 1536,
    "gte-large-fine-tuned": 1024,
}

# Context length in tokens of each language model.
CONTEXT_LENGTHS = {
    "gpt-4": 8192,
    "gpt-3.5-turbo": 4096,
    "gpt-3.5-turbo-16k": 16384,
    "gpt-4-1106-preview": 128000,
    "meta-llama/Llama-2-7b-chat-hf": 4096,
    "meta-llama/Llama-2-13b-chat-hf": 4096,
    "meta-llama/Llama-2-70b-chat-hf": 4096,
    "meta-llama/Llama-3-8b-chat-hf": 8192,
    "meta-llama/Llama-3-70b-chat-hf": 8192,
    "codellama/CodeLlama-34b-Instruct-hf": 16384,
    "mistralai/Mistral-7B-Instruct-v0.1": 65536,
    "mistralai/Mixtral-8x7B-Instruct-v0.1": 32768,
    "mistralai/Mixtral-8x22B-Instruct-v0.1": 65536,
}

# Price per million tokens, (prompt, sampled).
PRICES = {
    "gpt-3.5-turbo": (1.5, 2.0),
    "gpt-4": (30.0, 60.0),
    "gpt-4-1106-preview": (10.0, 30.0),
    "llama-2-7b-chat-hf": (0.15, 0.15),
    "llama-2-13b-chat-hf": (0.25, 0.25),
    "llama-2-70b-chat-hf": (1.0, 1.0),
    "llama-3-8b-chat-hf": (0.15, 0.15),
    "llama-3-70b-chat-hf": (1.0, 1.0),
    "codellama-34b-instruct-hf": (1.0, 1.0),
    "mistral-7b-instruct-v0.1": (0.15, 0.15),
    "mixtral-8x7b-instruct-v0.1": (0.5, 0.5),
    "mixtral-8x22b-instruct-v0.1": (0.9, 0.9),
}


def embedding_dimensions(spark: SparkSession) -> DataFrame:
    """``(model, dim)``."""
    return spark.createDataFrame(list(DIMENSIONS.items()), "model string, dim int")


def context_lengths(spark: SparkSession) -> DataFrame:
    """``(model, max_context)``."""
    return spark.createDataFrame(list(CONTEXT_LENGTHS.items()), "model string, max_context int")


def prices(spark: SparkSession) -> DataFrame:
    """``(model, prompt_price, sampled_price)``."""
    rows = [(model, prompt, sampled) for model, (prompt, sampled) in PRICES.items()]
    return spark.createDataFrame(rows, "model string, prompt_price double, sampled_price double")


def model_catalogue(spark: SparkSession) -> DataFrame:
    """``(name, max_context, prompt_price, sampled_price)``; ``name`` is the short lower-case name."""
    contexts = context_lengths(spark).select(
        F.lower(F.substring_index("model", "/", -1)).alias("name"), "model", "max_context"
    )
    return contexts.join(F.broadcast(prices(spark).withColumnRenamed("model", "name")), "name", "left")


def catalogue_join(experiments: DataFrame, name: str = "experiment_name") -> DataFrame:
    """Experiments with their model's context length and prices; unknown models stay."""
    catalogue = model_catalogue(experiments.sparkSession).withColumnRenamed("name", name)
    return experiments.join(F.broadcast(catalogue), name, "left")


def context_length(llm: Column, unknown: int = 4096) -> Column:
    """A model's context length by its full or short name; ``unknown`` for others."""
    by_name = {k.lower(): n for name, n in CONTEXT_LENGTHS.items() for k in (name, name.rpartition("/")[2])}
    known = F.create_map(*[F.lit(x) for pair in sorted(by_name.items()) for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(llm)), F.lit(unknown))
