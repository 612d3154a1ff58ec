"""Evaluation, metric, cost and split checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.catalogue import PRICES, prices
from lectern.checks.registry import QA_CTE, check, guessed_language, guessed_language_sql
from lectern.functions.text import words
from lectern.operators import cost, evaluation, metrics, ranking, vocabulary
from lectern.operators.rerank import keep_tags_else_other

HIT_SQL = "(source = '' OR list_contains(list_transform(sources, lambda s: string_split(s, '#')[1]), string_split(source, '#')[1]))"


def _references(t):
    return t.qa.select("pos", "question", "source", "reference_answer")


def _generated(t):
    """Every tenth answers another question, every seventh is missing, and as many answer what nobody asked."""
    own = F.when(F.col("pos") % 10 == 0, "changed").otherwise(F.col("question")).alias("question")
    pos = F.when(F.col("pos") % 7 == 0, -1 - F.col("pos")).otherwise(F.col("pos")).alias("pos")
    return t.qa.select(pos, own, "answer", "sources")


GAPS_CTE = """g AS (SELECT CASE WHEN pos % 7 = 0 THEN -1 - pos ELSE pos END AS pos, CASE WHEN pos % 10 = 0 THEN 'changed' ELSE question END AS question,
 answer, sources, experiment_name FROM qa),
paired AS (SELECT coalesce(r.pos, g.pos) AS pos, CASE WHEN r.pos IS NULL THEN g.question ELSE r.question END AS question, r.source, r.reference_answer,
 g.answer, g.sources, g.experiment_name, r.pos IS NOT NULL AND g.pos IS NOT NULL AND r.question = g.question AS same_question FROM qa r FULL JOIN g ON r.pos = g.pos)"""


@check(
    "join_refs_generated",
    f"WITH {QA_CTE}, {GAPS_CTE} SELECT pos, question, source, reference_answer, answer, same_question FROM paired",
)
def join_refs_generated(t):
    return evaluation.join_refs_generated(_references(t), _generated(t)).drop("sources")


@check(
    "retrieval_score",
    f"WITH {QA_CTE} SELECT experiment_name, round(avg({HIT_SQL}::int), 6) AS retrieval_score, count(*) AS n_questions FROM qa GROUP BY 1",
)
def retrieval_score(t):
    scores = evaluation.retrieval_score(t.qa, ["experiment_name"])
    return scores.withColumn("retrieval_score", F.round("retrieval_score", 6))


COUNTED = "(score <> 0 AND reference_answer <> '')"


@check("filter_scored_with_reference", f"WITH {QA_CTE} SELECT pos, score, reference_answer FROM qa WHERE {COUNTED}")
def filter_scored_with_reference(t):
    return evaluation.filter_scored_with_reference(t.qa).select("pos", "score", "reference_answer")


@check(
    "quality_score",
    f"""WITH {QA_CTE} SELECT experiment_name, round(avg(score) FILTER {COUNTED}, 6) AS quality_score, count(*) FILTER {COUNTED} AS n_scored,
count(*) FILTER (NOT coalesce({COUNTED}, false)) AS n_left_out FROM qa GROUP BY 1""",
)
def quality_score(t):
    return evaluation.quality_score(t.qa, ["experiment_name"]).withColumn("quality_score", F.round("quality_score", 6))


@check(
    "mean_reference_score",
    f"WITH {QA_CTE}, r AS (SELECT try_cast(string_split(raw, chr(10))[1] AS double) AS s FROM qa) SELECT round(avg(s), 6) AS mean_score FROM r WHERE s <> 0",
)
def mean_reference_score(t):
    first_line = t.qa.select(F.substring_index("raw", "\n", 1).alias("score"))
    return evaluation.mean_reference_score(first_line).select(F.round("mean_score", 6).alias("mean_score"))


SCORES_SQL = f"""SELECT experiment_name, round(avg({HIT_SQL}::int), 6) AS retrieval_score,
CASE WHEN experiment_name LIKE 'u%' THEN NULL ELSE round(avg(score) FILTER {COUNTED}, 6) END AS quality_score FROM qa GROUP BY 1"""


def experiment_table(t):
    scores = evaluation.retrieval_score(t.qa, ["experiment_name"]).join(
        evaluation.quality_score(t.qa, ["experiment_name"]), "experiment_name"
    )
    known = F.when(~F.col("experiment_name").startswith("u"), F.round("quality_score", 6))
    return scores.select("experiment_name", F.round("retrieval_score", 6).alias("retrieval_score"), known.alias("quality_score"))


@check("experiment_scores", f"WITH {QA_CTE} {SCORES_SQL}")
def experiment_scores(t):
    return evaluation.experiment_scores(experiment_table(t))


@check(
    "top_experiments",
    f"WITH {QA_CTE} SELECT * FROM ({SCORES_SQL}) ORDER BY quality_score DESC NULLS FIRST, retrieval_score DESC, experiment_name LIMIT 3",
)
def top_experiments(t):
    return evaluation.top_experiments(experiment_table(t))


PRICE_VALUES = "(VALUES " + ", ".join(f"('{m}', {a}::double, {b}::double)" for m, (a, b) in PRICES.items()) + ") p(experiment_name, pp, sp)"
COST_CTE = f"""s AS (SELECT experiment_name, count(*) AS num_samples, sum(ceil(length(question) / 4)) AS qt, sum(ceil(length(answer) / 4)) AS st,
 length(experiment_name) * 10 AS chunk_size, length(experiment_name) % 9 AS num_chunks FROM qa GROUP BY 1),
c0 AS (SELECT s.*, pp, sp, CASE WHEN experiment_name NOT LIKE 'llama%' THEN qt + (chunk_size / 5) * (4 / 3) * num_chunks * num_samples END AS pt FROM s LEFT JOIN {PRICE_VALUES} USING (experiment_name)),
costs AS (SELECT experiment_name, num_samples, cast(floor(pt / num_samples) AS bigint) AS avg_prompt_tokens, cast(floor(st / num_samples) AS bigint) AS avg_sampled_tokens,
 pp / 1e6 * pt + sp / 1e6 * st AS total_cost FROM c0)"""


def cost_table(t):
    return cost.cost_analysis(
        t.qa.select("experiment_name", "question", F.col("answer").alias("generated_answer")),
        t.experiment_configs.where("experiment_name not like 'llama%'"),
        prices(t.spark),
    )


@check(
    "cost_analysis",
    f"""WITH {QA_CTE}, {COST_CTE} SELECT experiment_name, num_samples, avg_prompt_tokens, avg_sampled_tokens,
round(total_cost, 10) AS total_cost, round(total_cost / num_samples, 10) AS avg_cost FROM costs""",
)
def cost_analysis(t):
    return cost_table(t).withColumn("total_cost", F.round("total_cost", 10)).withColumn("avg_cost", F.round("avg_cost", 10))


@check(
    "cost_multiplier",
    f"""WITH {QA_CTE}, {COST_CTE} SELECT c.experiment_name, round((c.total_cost / c.num_samples) / (b.total_cost / b.num_samples), 6) AS multiplier
FROM costs c, costs b WHERE b.experiment_name = 'mixtral-8x7b-instruct-v0.1'""",
)
def cost_multiplier(t):
    return cost.cost_multiplier(cost_table(t), "mixtral-8x7b-instruct-v0.1").withColumn("multiplier", F.round("multiplier", 6))


# -- classification metrics --------------------------------------------------------

LABELLED_CTE = f"labelled AS (SELECT doc_id, lang AS actual, {guessed_language_sql('text')} AS predicted FROM documents)"


def labelled(t):
    guess = guessed_language(words(F.lower("text")))
    return t.texts.select("doc_id", F.col("lang").alias("actual"), guess.alias("predicted"))


@check(
    "tag_counts",
    """SELECT 'before' AS stage, source AS tag, count(*) AS n FROM documents GROUP BY ALL UNION ALL
SELECT 'after', CASE WHEN source IN ('src1', 'src2', 'src3') THEN source ELSE 'other' END, count(*) FROM documents GROUP BY ALL""",
)
def tag_counts(t):
    before = metrics.tag_counts(t.documents.select(F.col("source").alias("tag")))
    kept = keep_tags_else_other(F.col("tag"), ["src1", "src2", "src3"])
    after = before.select(kept.alias("tag"), "n").groupBy("tag").agg(F.sum("n").alias("n"))
    return before.select(F.lit("before").alias("stage"), "tag", "n").unionByName(after.select(F.lit("after").alias("stage"), "tag", "n"))


@check("confusion_matrix", f"WITH {LABELLED_CTE} SELECT actual, predicted, count(*) AS n FROM labelled GROUP BY ALL")
def confusion_matrix(t):
    return metrics.confusion_matrix(labelled(t))


@check(
    "weighted_prf",
    f"""WITH {LABELLED_CTE}, c AS (SELECT a.actual AS label, count(*) AS support, count(*) FILTER (a.actual = a.predicted) AS hits,
(SELECT count(*) FROM labelled p WHERE p.predicted = a.actual) AS called FROM labelled a GROUP BY a.actual),
r AS (SELECT *, CASE WHEN called > 0 THEN hits / called ELSE 0 END AS p, hits / support AS r FROM c)
SELECT round(sum(p * support) / sum(support), 6) AS precision, round(sum(r * support) / sum(support), 6) AS recall,
round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support), 6) AS f1, sum(support)::double AS num_samples FROM r""",
)
def weighted_prf(t):
    scores = metrics.weighted_prf(labelled(t))
    return scores.select(*[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "num_samples")


@check(
    "routing_summary",
    f"""WITH {QA_CTE}, r AS (SELECT length(question) % 2 AS predicted, score FROM qa)
SELECT predicted, count(*) AS n, round(count(*) / (SELECT count(*) FROM r), 6) AS share, round(avg(score), 6) AS mean_score FROM r GROUP BY 1""",
)
def routing_summary(t):
    routed = t.qa.select((F.length("question") % 2).alias("predicted"), "score")
    return metrics.routing_summary(routed).withColumn("share", F.round("share", 6)).withColumn("mean_score", F.round("mean_score", 6))


WORDS2 = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}_]+'), lambda w: length(w) >= 2)"


@check(
    "tfidf_weights",
    f"""WITH tf AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest({WORDS2}) AS w FROM documents) GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY 1), n AS (SELECT count(*) AS n FROM documents),
r AS (SELECT doc_id, w, tf * (ln((1 + n) / (1 + df)) + 1) AS raw FROM tf JOIN df USING (w), n)
SELECT doc_id, w, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM r""",
)
def tfidf_weights(t):
    return vocabulary.tfidf_weights(t.texts).withColumn("weight", F.round("weight", 6))


# -- splits and ids ----------------------------------------------------------------


@check(
    "split_prefix",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) - 1 < floor(0.8::double * count(*) OVER ()) THEN 'train' ELSE 'validation' END AS part FROM documents""",
)
def split_prefix(t):
    return ranking.split_prefix(t.documents.select("doc_id"), "doc_id")


@check(
    "split_stratified",
    """SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY md5(doc_id || '#1234'), doc_id) <= ceil(0.2::double * count(*) OVER (PARTITION BY source))
THEN 'test' ELSE 'train' END AS part FROM documents""",
)
def split_stratified(t):
    return ranking.split_stratified(t.documents.select("doc_id", "source"), "source", "doc_id")


@check(
    "assign_chunk_id",
    """SELECT source, doc_id, row_number() OVER (ORDER BY md5(source || '#' || doc_id), source, doc_id) AS chunk_id FROM documents""",
)
def assign_chunk_id(t):
    return ranking.assign_chunk_id(t.documents.select("source", "doc_id"), ["source", "doc_id"])
