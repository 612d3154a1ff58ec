"""Word sets and TF-IDF weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import explode_words, letter_words
from lectern.operators.joins import join_frequent_keys
from lectern.session import materialize


def unique_words(texts: DataFrame, text: str = "text") -> DataFrame:
    """``(word)``: distinct lower-cased letter-only words."""
    return explode_words(texts, tokens=letter_words(F.col(text)), out="word").distinct()


def oov_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Words that the vocabulary lacks."""
    return words.join(vocabulary.select("word"), "word", "left_anti")


def model_words(text: Column) -> Column:
    """Lower-cased words of two or more word characters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 2)


# Most frequent words whose rows stay where they are when weights are told.
FREQUENT_WORDS = 100_000


def word_counts(documents: DataFrame, key: str, text: str) -> DataFrame:
    """``(w, key, tf)``. Whole texts are brought together by key; their words are counted there, not sent one by one."""
    spark = documents.sparkSession
    # A fixed number: the words of a partition are many times its texts, by whose size partitions would be merged.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism, documents.rdd.getNumPartitions())
    together = documents.select(key, text).repartition(tasks, key)
    return explode_words(together, key, tokens=model_words(F.col(text))).groupBy("w", key).agg(F.count("*").alias("tf"))


def tfidf_weights(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, w, weight)``: ``tf * (ln((1 + n) / (1 + df)) + 1)``, unit length per document.

    The counts are written once; frequent words stay where they are in the join.
    """
    tf = materialize(word_counts(documents, key, text), "tf")
    df = materialize(tf.groupBy("w").agg(F.count("*").alias("df")), "df")
    n = documents.agg(F.count("*").alias("n")).scalar()
    raw = F.col("tf") * (F.log((n + 1) / (F.col("df") + 1)) + 1)
    weighted = join_frequent_keys(tf, df, "w", "df", FREQUENT_WORDS).select(key, "w", raw.alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(key)))
    return weighted.select(key, "w", (F.col("raw") / norm).alias("weight"))
