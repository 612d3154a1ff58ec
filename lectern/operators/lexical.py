"""BM25: statistics, scores and top-k for many questions at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import bm25_corpus_tokens, bm25_query_tokens, explode_words
from lectern.operators.block_topk import TOPK_SCHEMA, best_hits, ranked
from lectern.operators.joins import MAX_BROADCAST_ROWS, broadcast_if_small
from lectern.operators.postings import NAMED_WORDS, beside_buckets, build_postings, copy_postings, layout, of_words, open_postings, peak_saturation, score_blocks
from lectern.session import materialize, path_exists, remove

# The usual BM25 constants.
K1 = 1.5
B = 0.75
EPSILON = 0.25

# Stands in the term table for "all documents"; no token is empty.
TOTALS = ""


@dataclass
class LexicalIndex:
    """``docs``: doc_id, dl. ``terms``: w, df, idf. ``stats``: n_docs, avgdl, mean_idf. ``postings``: blocks by word and shard."""

    docs: DataFrame
    terms: DataFrame
    stats: DataFrame
    postings: DataFrame


def tokenize_corpus(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, dl, tokens)``."""
    tokens = F.coalesce(bm25_corpus_tokens(F.col(text)), F.array().cast("array<string>"))
    return documents.select(F.col(key).alias("doc_id"), tokens.alias("tokens")).select(
        "doc_id", F.size("tokens").alias("dl"), "tokens"
    )


def tokenize_queries(questions: DataFrame, key: str = "qid", text: str = "question", normalize_query: bool = False) -> DataFrame:
    """``(qid, w, qtf)``: the distinct words of each question with their counts."""
    tokens = bm25_query_tokens(F.col(text), normalize_query)
    return (
        explode_words(questions, F.col(key).alias("qid"), tokens=tokens)
        .groupBy("qid", "w")
        .agg(F.count("*").alias("qtf"))
    )


def count_terms(docs: DataFrame) -> DataFrame:
    """``(w, df, total)`` plus one row for ``TOTALS`` with the document count and summed length.

    One pass: the corpus totals ride along as a term that every document has,
    and partial counts keep frequent words from piling up anywhere.
    """
    with_totals = F.array_append(F.array_distinct("tokens"), F.lit(TOTALS))
    return (
        explode_words(docs, "dl", tokens=with_totals)
        .groupBy("w")
        .agg(F.count("*").alias("df"), F.sum(F.when(F.col("w") == TOTALS, F.col("dl"))).alias("total"))
    )


def bm25_stats(counted: DataFrame) -> DataFrame:
    """One row ``(n_docs, n_terms, total_length, avgdl, mean_idf)`` from ``count_terms``.

    ``mean_idf`` is the mean over all terms before negative values are replaced;
    it is summed as decimals, which gives the same value in any order.
    """
    total = counted.where(F.col("w") == TOTALS).select("df").scalar()
    real = F.col("w") != TOTALS
    raw = F.log(total - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    return counted.agg(
        F.max(F.when(~real, F.col("df"))).alias("n_docs"),
        F.count(F.when(real, 1)).alias("n_terms"),
        F.max("total").alias("total_length"),
        F.max(F.when(~real, F.try_divide("total", "df"))).alias("avgdl"),
        F.avg(F.when(real, raw.cast("decimal(30, 15)"))).cast("double").alias("mean_idf"),
    )


def bm25_idf(counted: DataFrame, stats: DataFrame) -> DataFrame:
    """``(w, df, idf)``; a negative idf becomes a quarter of the mean."""
    raw = F.log(stats.select("n_docs").scalar() - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    floor = F.lit(EPSILON) * stats.select("mean_idf").scalar()
    return counted.where(F.col("w") != TOTALS).select(
        "w", "df", F.when(raw < 0, floor).otherwise(raw).alias("idf")
    )


def build_lexical_index(documents: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> LexicalIndex:
    """One pass over the texts gives the stored postings (see ``postings``); term table and statistics come from those.

    Documents are named by their ids; rows without one take no part.
    """
    documents = documents.where(F.col(key).isNotNull())
    n_docs = documents.count()
    blocks = build_postings(documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), n_docs, path)
    words = blocks.groupBy("w").agg(F.sum("n").alias("df"), F.sum("n_tokens").alias("n_tokens"))
    words = materialize(words, "terms")
    totals = words.agg(F.lit(TOTALS).alias("w"), F.lit(n_docs).cast("long").alias("df"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("total"))
    counted = words.select("w", "df", F.lit(None).cast("long").alias("total")).unionByName(totals)
    # One row: fetched, so that the plans of a search hold its numbers.
    found = bm25_stats(counted)
    stats = documents.sparkSession.createDataFrame([found.first()], found.schema)
    return LexicalIndex(tokenize_corpus(documents, key, text).select("doc_id", "dl"), bm25_idf(counted, stats), stats, blocks)


def write_lexical_index(index: LexicalIndex, path: str) -> None:
    """Store the four tables below ``path``; the statistics come last."""
    for name in ("docs", "terms"):
        getattr(index, name).write.mode("overwrite").parquet(f"{path}/{name}")
    remove(index.stats.sparkSession, f"{path}/postings")
    copy_postings(index.postings, index.stats.first()["n_docs"] or 0, f"{path}/postings")
    index.stats.write.mode("overwrite").parquet(f"{path}/stats")


def read_lexical_index(spark, path: str) -> LexicalIndex:
    """Open an index stored by ``write_lexical_index``."""
    if not path_exists(spark, f"{path}/stats"):
        raise FileNotFoundError(path)
    docs, terms, stats = (spark.read.parquet(f"{path}/{n}") for n in ("docs", "terms", "stats"))
    _, buckets, _ = layout(stats.first()["n_docs"] or 0)
    return LexicalIndex(docs, terms, stats, open_postings(spark, f"{path}/postings", buckets))


def postings_join(index: LexicalIndex, query_terms: DataFrame, names: int = NAMED_WORDS, most: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``(w, doc_id, tf, idf)``: postings and idf of the words that occur in some question.

    Only the asked words' buckets are read, and no posting is shuffled.
    """
    asked = materialize(index.terms.join(broadcast_if_small(query_terms.select("w").distinct()), "w", "left_semi").select("w", "idf"), "asked")
    blocks = of_words(index.postings.select("w", "doc_ids", "tfs"), asked, names, most)
    pairs = blocks.join(beside_buckets(asked, asked, most), "w").select("w", "idf", F.inline(F.arrays_zip(F.col("doc_ids").alias("doc_id"), F.col("tfs").alias("tf"))))
    return pairs.select("w", "doc_id", "tf", "idf")


def weigh_words(index: LexicalIndex, questions: DataFrame, normalize_query: bool = False) -> DataFrame:
    """``(w, qid, weight)``, written: what each known word of a question weighs."""
    terms = broadcast_if_small(tokenize_queries(questions, normalize_query=normalize_query))
    weighed = index.terms.select("w", "idf").join(terms, "w").select("w", "qid", (F.col("qtf") * F.col("idf")).alias("weight"))
    return materialize(weighed.where("weight <> 0"), "weighed")


def _average(index: LexicalIndex) -> float:
    return float(index.stats.first()["avgdl"] or 1.0)


def shard_bounds(index: LexicalIndex, asked: DataFrame, k1: float, b: float, names: int = NAMED_WORDS) -> DataFrame:
    """``(qid, shard, bound, reached)``: no document of the shard scores more than ``bound``.

    If no word of the question weighs less than 0, some document of the shard scores
    ``reached`` at least: the best of what one word alone gives. Both come from
    the peaks of the blocks; no posting is read.
    """
    blocks = of_words(index.postings.select("w", "shard", "peaks"), asked, names)
    tops = blocks.select("w", "shard", peak_saturation(k1, b, _average(index)).alias("top"))
    gain = F.col("weight") * F.col("top")
    return tops.join(beside_buckets(asked, asked), "w").groupBy("qid", "shard").agg(F.sum(F.greatest(gain, F.lit(0.0))).alias("bound"), F.max(gain).alias("reached"))


def surviving_shards(index: LexicalIndex, asked: DataFrame, k: int, k1: float, b: float, names: int = NAMED_WORDS) -> DataFrame:
    """``(qid, shard, stays)``: a shard stays unless ``k`` others hold a document each that beats all of its.

    Questions with a word that weighs less than 0 keep all their shards.
    """
    bounds = materialize(shard_bounds(index, asked, k1, b, names), "bounds")
    sinking = asked.groupBy("qid").agg((F.min("weight") < 0).alias("sinks"))
    order = Window.partitionBy("qid").orderBy(F.col("reached").desc())
    bar = bounds.where("reached > 0").withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k).where(F.col("nth") == k)
    bar = bar.join(sinking.where("not sinks"), "qid", "left_semi").select("qid", F.col("reached").alias("bar"))
    # Scores are compared at nine digits.
    stays = F.col("bar").isNull() | (F.col("bound") * (1 + 1e-9) + 1e-8 >= F.col("bar"))
    return bounds.join(bar, "qid", "left").select("qid", "shard", stays.alias("stays"))


def skipped_blocks(index: LexicalIndex, questions: DataFrame, k: int, normalize_query: bool = False, k1: float = K1, b: float = B) -> DataFrame:
    """``(qid, n_shards, n_read)``: in how many shards a question has words, and how many of them a search for ``k`` documents reads."""
    found = surviving_shards(index, weigh_words(index, questions, normalize_query), k, k1, b)
    return found.groupBy("qid").agg(F.count("*").alias("n_shards"), F.sum(F.col("stays").cast("long")).alias("n_read"))


def asking_blocks(index: LexicalIndex, asked: DataFrame, shards: DataFrame | None, names: int) -> DataFrame:
    """The blocks of the asked words with ``asks``, who asks for them; with ``shards`` (``qid, shard``) only those that stay."""
    blocks = of_words(index.postings.select("w", "shard", "doc_ids", "tfs", "dls"), asked, names)
    ask = F.collect_list(F.struct("qid", "weight")).alias("asks")
    if shards is None:
        return blocks.join(beside_buckets(asked.groupBy("w").agg(ask), asked), "w")
    each = materialize(shards.join(asked, "qid").select("w", "shard", "qid", "weight"), "asks")
    return blocks.join(beside_buckets(each.groupBy("w", "shard").agg(ask), each), ["w", "shard"])


def without_hits(index: LexicalIndex, short: DataFrame, asked: DataFrame, k: int, names: int) -> DataFrame:
    """``(qid, doc_id, score, rank_score)``: the ``k`` lowest ids of documents that hold no word of the question, score 0.

    ``short`` has ``qid``. A question that found fewer than ``k`` documents has
    that many hits at most, so twice ``k`` ids do, unless words weigh less than
    0; then more ids are taken until they do.
    """
    own = asked.join(F.broadcast(short), "qid", "left_semi")
    blocks = of_words(index.postings.select("w", "doc_ids"), own, names).join(F.broadcast(own.select("w", "qid")), "w")
    hits = materialize(blocks.select("qid", F.explode("doc_ids").alias("doc_id")).distinct(), "hits")
    n = 2 * k
    while True:
        lowest = index.docs.select("doc_id").distinct().orderBy("doc_id").limit(n)
        free = materialize(short.crossJoin(F.broadcast(lowest)).join(hits, ["qid", "doc_id"], "left_anti"), "free")
        lacking = short.join(free.groupBy("qid").count().where(F.col("count") >= k), "qid", "left_anti")
        if lacking.isEmpty() or lowest.count() < n:
            return free.select("qid", "doc_id", F.lit(0.0).alias("score"), F.lit(0.0).alias("rank_score"))
        n *= 4


def lexical_topk(
    index: LexicalIndex, questions: DataFrame, k: int, normalize_query: bool = False, k1: float = K1, b: float = B, names: int = NAMED_WORDS
) -> DataFrame:
    """``(qid, pos, doc_id, score)``: best BM25 scores, ties by id.

    Every document counts: those without a matching word (score 0) fill up to
    ``k`` and outrank negative scores. Shards that cannot hold one of the best
    ``k`` are left out, exactly; only the others' postings are read and shuffled.
    """
    if k <= 0:
        return questions.sparkSession.createDataFrame([], "qid bigint, pos int, doc_id bigint, score double")
    asked = weigh_words(index, questions, normalize_query)
    # With no more shards than documents are wanted, none can be left out.
    several = layout(index.stats.first()["n_docs"] or 0)[0] > k
    shards = surviving_shards(index, asked, k, k1, b, names).where("stays").select("qid", "shard") if several else None
    blocks = asking_blocks(index, asked, shards, names)
    best = materialize(ranked(score_blocks(blocks, best_hits(k), TOPK_SCHEMA, k1, b, _average(index)), k), "best")
    full = best.where("rank_score > 0").groupBy("qid").count().where(F.col("count") >= k)
    short = materialize(questions.select(F.col("qid").cast("long").alias("qid")).distinct().join(full, "qid", "left_anti"), "short")
    if not short.isEmpty():
        fill = without_hits(index, short, asked, k, names)
        best = ranked(best.drop("pos").unionByName(fill), k)
    return best.select("qid", "pos", "doc_id", "score")


def bm25_score(index: LexicalIndex, questions: DataFrame, normalize_query: bool = False, k1: float = K1, b: float = B, names: int = NAMED_WORDS) -> DataFrame:
    """``(qid, n_matched, total_score, best_score)`` of each question over the whole corpus.

    Hits are summed up inside each task; no question-document pair leaves it.
    """
    asked = weigh_words(index, questions, normalize_query)

    def reduce(hits):
        held = {}
        for q, _, s in hits:
            each, first = np.unique(q, return_index=True)
            found = zip(each.tolist(), np.add.reduceat((s != 0).astype(np.int64), first).tolist(), np.add.reduceat(s, first).tolist(), np.maximum.reduceat(s, first).tolist())
            for qid, n, total, top in found:
                old = held.get(qid, (0, 0.0, -np.inf))
                held[qid] = (old[0] + n, old[1] + total, max(old[2], top))
        rows = [(q, *v) for q, v in held.items()]
        names_of = (("qid", pa.int64()), ("n_matched", pa.int64()), ("total_score", pa.float64()), ("best_score", pa.float64()))
        yield pa.record_batch({n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(names_of)})

    schema = "qid bigint, n_matched bigint, total_score double, best_score double"
    partial = score_blocks(asking_blocks(index, asked, None, names), reduce, schema, k1, b, _average(index))
    found = partial.groupBy("qid").agg(F.sum("n_matched").alias("n"), F.sum("total_score").alias("total"), F.max("best_score").alias("best"))
    n_docs = index.stats.first()["n_docs"] or 0
    # A document without any of the words scores 0.
    top = F.when(F.coalesce("n", F.lit(0)) < n_docs, F.greatest(F.coalesce("best", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("best"))
    joined = questions.select(F.col("qid").cast("long").alias("qid")).join(found, "qid", "left")
    return joined.select("qid", F.coalesce("n", F.lit(0)).cast("long").alias("n_matched"), F.coalesce("total", F.lit(0.0)).alias("total_score"), top.alias("best_score"))
