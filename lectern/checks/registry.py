"""The registry and the tables that the registered queries share.

Derived columns are SQL expressions that mean the same in Spark and in the
checking engine, so both sides read them from one place.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.catalogue import PRICES
from lectern.sources.tables import load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register ``fn(tables)`` as query ``name``."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLES[name] = sql
        return fn

    return register


TAG_PREFIX = "docs.example.com/latest/"
DOC_SOURCE = "'https://docs.example.com/latest/' || lang || '/' || source || '.html#d' || cast(doc_id as string)"
DOC_URL = "'https://docs.example.com/latest/' || lang || '/' || source || '/' || cast(doc_id as string) || '.html'"
ESCAPED = "replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"
DOC_HTML = (
    "'<html><head><title>T</title><script>var x = \"<p>\";</script></head><body><nav>skip</nav><section id=\"d' || "
    "cast(doc_id as string) || '\"><h1>' || lang || '</h1><p>' || " + ESCAPED + " || '</p><section id=\"d' || "
    "cast(doc_id as string) || '-len\"><p>' || cast(n_chars as string) || '</p></section><!-- c --></section>"
    "<section><p>no id</p></section></body></html>'"
)

# Question/answer rows of the conversations.
EXPERIMENTS = [*sorted(PRICES), "unpriced-model"]
_P = "'https://docs.example.com/latest/en/p' || cast("
REF_SOURCE = f"case when length(question) % 5 = 0 then '' else {_P}conv_id % 7 as string) || '.html#s' || cast(turn as string) end"
SOURCE_1 = f"{_P}length(question) % 7 as string) || '.html#a'"
SOURCE_2 = f"{_P}turn % 7 as string) || '.html'"
SOURCE_3 = f"{_P}length(answer) % 7 as string) || '.html#b'"
REF_ANSWER = "case when length(answer) % 4 = 0 then '' else 're: ' || question end"
RAW_JUDGE_SPARK = r"""case when length(question) % 11 = 0 then 'no score' when length(question) % 13 = 0 then 'n/a\nreason'
 else cast(length(answer) % 6 as string) || '\n\n' || 'because ' || cast(turn as string) end"""
RAW_JUDGE_SQL = RAW_JUDGE_SPARK.replace("'n/a\\nreason'", "'n/a' || chr(10) || 'reason'").replace("'\\n\\n'", "chr(10) || chr(10)")
SCORE = """case when length(question) % 11 = 0 then 0.0e0 when length(question) % 13 = 0 then null
 else cast(length(answer) % 6 as double) end"""

QA_CTE = f"""qa0 AS (SELECT u.conv_id * 1000000 + u.turn AS pos, u.conv_id, u.turn, u.text AS question, a.text AS answer
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'),
qa AS (SELECT *, ({EXPERIMENTS!r})[conv_id % {len(EXPERIMENTS)} + 1] AS experiment_name, {REF_SOURCE} AS source,
  [{SOURCE_1}, {SOURCE_2}, {SOURCE_3}] AS sources, {REF_ANSWER} AS reference_answer, {RAW_JUDGE_SQL} AS raw,
  {SCORE} AS score FROM qa0)"""

DOCS_CTE = f"docs AS (SELECT doc_id, text, lang, source AS tag, n_chars, {DOC_SOURCE} AS source FROM documents)"
QUESTIONS_CTE = "questions AS (SELECT item_id AS qid, text AS question FROM benchmark)"

TOKENS = "list_filter(string_split(lower(regexp_replace({0}, '[^a-zA-Z0-9]+', ' ', 'g')), ' '), lambda t: t <> '')"
WORDS = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda t: t <> '')"

# Words that give a language away, most telling language first.
TELLING = {
    "de": ["der", "die", "und", "ist"],
    "es": ["los", "las", "del", "el"],
    "fr": ["les", "des", "est", "une"],
    "en": ["the", "of", "and", "that"],
}


def guessed_language(tokens) -> F.Column:
    guess = F.lit("other")
    for lang in reversed(TELLING):
        guess = F.when(F.arrays_overlap(tokens, F.array(*[F.lit(w) for w in TELLING[lang]])), lang).otherwise(guess)
    return guess


def guessed_language_sql(text: str) -> str:
    tokens = WORDS.format(f"lower({text})")
    cases = " ".join(f"WHEN list_has_any({tokens}, {ws!r}) THEN '{lang}'" for lang, ws in TELLING.items())
    return f"CASE {cases} ELSE 'other' END"


class Tables:
    """The given tables and what the checks derive from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def load(self, name: str, spread_by: str | None = None) -> DataFrame:
        return load_table(self.spark, f"{self.folder}/{name}.parquet", spread_by)

    @cached_property
    def documents(self) -> DataFrame:
        return self.load("documents")

    @cached_property
    def texts(self) -> DataFrame:
        """The documents for work on whole texts, on all cores even when they are one file."""
        return self.load("documents", "doc_id")

    @cached_property
    def docs(self) -> DataFrame:
        """doc_id, text, lang, tag, n_chars and a URL as source."""
        return self.documents.select(
            "doc_id", "text", "lang", F.col("source").alias("tag"), "n_chars", F.expr(DOC_SOURCE).alias("source")
        )

    @cached_property
    def doc_pages(self) -> DataFrame:
        """Each document as an HTML page with sections."""
        return self.texts.select("doc_id", F.expr(DOC_URL).alias("url"), F.expr(DOC_HTML).alias("html"))

    @cached_property
    def pages(self) -> DataFrame:
        return self.load("pages")

    @cached_property
    def page_texts(self) -> DataFrame:
        """The pages for work on whole texts."""
        return self.load("pages", "page_id")

    @cached_property
    def questions(self) -> DataFrame:
        return self.load("benchmark").select(F.col("item_id").alias("qid"), F.col("text").alias("question"))

    @cached_property
    def vectors(self) -> DataFrame:
        return self.load("embeddings", "vec_id").select(F.col("vec_id").alias("doc_id"), "embedding", "label")

    @cached_property
    def labels(self) -> DataFrame:
        return self.load("labels")

    @cached_property
    def turns(self) -> DataFrame:
        return self.load("conversations")

    @cached_property
    def events(self) -> DataFrame:
        return self.load("events")

    @cached_property
    def qa(self) -> DataFrame:
        """User turns with the assistant turn that follows, and derived references, sources and scores."""
        user = self.turns.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("question"))
        reply = self.turns.where("role = 'assistant'").select(
            "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer")
        )
        names = F.array(*[F.lit(e) for e in EXPERIMENTS])
        return (
            user.join(reply, ["conv_id", "turn"])
            .withColumn("pos", F.col("conv_id") * 1000000 + F.col("turn"))
            .withColumn("experiment_name", F.get(names, (F.col("conv_id") % len(EXPERIMENTS)).cast("int")))
            .withColumn("source", F.expr(REF_SOURCE))
            .withColumn("sources", F.array(F.expr(SOURCE_1), F.expr(SOURCE_2), F.expr(SOURCE_3)))
            .withColumn("reference_answer", F.expr(REF_ANSWER))
            .withColumn("raw", F.expr(RAW_JUDGE_SPARK))
            .withColumn("score", F.expr(SCORE))
        )

    @cached_property
    def experiment_configs(self) -> DataFrame:
        """One config row per experiment that occurs."""
        size = F.length("experiment_name")
        return self.qa.select("experiment_name").distinct().select(
            "experiment_name",
            (size * 10).cast("int").alias("chunk_size"),
            F.lit(50).alias("chunk_overlap"),
            (size % 9).cast("int").alias("num_chunks"),
            F.col("experiment_name").alias("llm"),
        )
