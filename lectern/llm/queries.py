"""The operators over their whole tables, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.decontamination import leaks
from lectern.llm.exact_topk import TOPK_SQL, exact_topk
from lectern.llm.line_windows import LINE_DEDUP_SQL, drop_repeated_lines
from lectern.llm.packing import pack_best_fit, pack_by_cost
from lectern.llm.personal_data import personal_data
from lectern.llm.quality import quality
from lectern.llm.simhash import near_copies
from lectern.llm.source_divergence import DIVERGENCE_SQL, source_divergences
from lectern.llm.suffix_arrays import drop_repeated_strings
from lectern.llm.toxicity import toxicity
from lectern.llm.url_rules import judge_urls
from lectern.llm.whitening import whiten

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}

# The rules of the URL query.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def query(name: str, sql: str | None = None):
    """Register ``fn(table)``, where ``table(name)`` reads a given table, as query ``name``."""

    def register(fn):
        LLM_QUERIES[name] = lambda spark, folder: fn(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))
        if sql:
            LLM_ORACLES[name] = sql
        return fn

    return register


@query("op1_suffix_dedup")
def op1_suffix_dedup(table):
    found = drop_repeated_strings(table("documents"), size=50, with_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op2_exact_topk", TOPK_SQL)
def op2_exact_topk(table):
    vectors = table("embeddings").select("vec_id", "embedding")
    return exact_topk(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256.0)


@query("op3_cost_packing")
def op3_cost_packing(table):
    return pack_by_cost(table("documents"), capacity=1024, end=0)


@query("op4_template_leaks")
def op4_template_leaks(table):
    return leaks(table("documents"), table("benchmark")).drop("k1", "k2")


@query("op5_toxicity")
def op5_toxicity(table):
    return toxicity(table("documents"), table("labels").select("doc_id", F.col("toxic").alias("label")))


@query("op6_quality")
def op6_quality(table):
    return quality(table("documents"))


@query("op7_url_rules")
def op7_url_rules(table):
    """Labels of a document teach the page that has its id: bad is low quality or toxic."""
    labels = table("labels").select(F.col("doc_id").alias("page_id"), F.expr("quality = 0 or toxic = 1").alias("bad"))
    return judge_urls(table("pages"), labels, URL_RULES)


@query("op8_simhash")
def op8_simhash(table):
    found = near_copies(table("documents"), size=3, within=3)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op9_best_fit_packing")
def op9_best_fit_packing(table):
    return pack_best_fit(table("documents"), capacity=1024)


@query("op10_line_windows", LINE_DEDUP_SQL)
def op10_line_windows(table):
    docs = table("documents").select("doc_id", "text")
    found = drop_repeated_lines(docs, size=3)
    return found.select(
        "doc_id", F.col("_lines_n").alias("n_lines"), F.col("_lines_removed").alias("n_removed"), F.col("_lines_spans").alias("n_spans"), "text"
    )


@query("op11_personal_data")
def op11_personal_data(table):
    return personal_data(table("documents"))


@query("op12_source_divergence", DIVERGENCE_SQL)
def op12_source_divergence(table):
    return source_divergences(table("documents"))


@query("op13_whitening")
def op13_whitening(table):
    return whiten(table("embeddings"))
