"""Embedding, search, merge, rerank and retrieval checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.checks.registry import DOCS_CTE, QUESTIONS_CTE, TAG_PREFIX, TOKENS, WORDS, check, guessed_language, guessed_language_sql
from lectern.functions.prompts import user_prompt
from lectern.functions.text import bm25_query_tokens
from lectern.functions.urls import url_tag
from lectern.operators import lexical
from lectern.operators.embedding import embed_chunks, embed_queries, mean_vectors, vector_entries
from lectern.operators.evaluation import num_chunks_sweep, retrieved_hit_semi
from lectern.operators.hybrid import attach_documents, hybrid_merge
from lectern.operators.metrics import ir_metrics
from lectern.operators.rerank import rerank_by_tag, rerank_truncate
from lectern.operators.semantic import distance_summary, semantic_topk
from lectern.operators.vector_index import build_vector_index, semantic_search
from lectern.plans.retrieval import RetrievalConfig, distinct_sources, gather_contexts, retrieve, retrieve_contexts

# -- SQL building blocks -----------------------------------------------------------

BM25_CTE = f"""{QUESTIONS_CTE}, {DOCS_CTE}, dl AS (SELECT doc_id, len({TOKENS.format('text')}) AS dl FROM documents),
tf AS (SELECT doc_id, w, count(*) AS tf FROM (SELECT doc_id, unnest({TOKENS.format('text')}) AS w FROM documents) GROUP BY ALL),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY w), st AS (SELECT count(*) AS n, avg(dl) AS avgdl, sum(dl) AS total FROM dl),
raw AS (SELECT w, df, ln(n - df + 0.5::double) - ln(df + 0.5::double) AS r FROM df, st), m AS (SELECT avg(r) AS mean_idf FROM raw),
idf AS (SELECT w, df, CASE WHEN r < 0 THEN 0.25 * mean_idf ELSE r END AS idf FROM raw, m),
qt AS (SELECT qid, w, count(*) AS qtf FROM (SELECT qid, unnest({WORDS.format('lower(question)')}) AS w FROM questions) GROUP BY ALL),
hit AS (SELECT qid, doc_id, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
  FROM qt JOIN tf USING (w) JOIN idf USING (w) JOIN dl USING (doc_id), st GROUP BY ALL),
scored AS (SELECT q.qid, d.doc_id, coalesce(h.score, 0) AS score FROM questions q CROSS JOIN dl d LEFT JOIN hit h USING (qid, doc_id)),
lex AS (SELECT qid, doc_id, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, doc_id) - 1 AS pos FROM scored)"""


def _entries_sql(name: str, key: str, tokens: str, table: str, dim: int = 256) -> str:
    return f"""{name}0 AS (SELECT {key}, ('0x' || substr(md5(w), 1, 8))::bigint % {dim} AS pos, count(*) AS n
  FROM (SELECT {key}, unnest({tokens}) AS w FROM {table}) GROUP BY ALL),
{name} AS (SELECT {key}, pos, cast(cast(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS float) AS double) AS v FROM {name}0)"""


SEMANTIC_CTE = f"""{_entries_sql('dv', 'doc_id', TOKENS.format('text'), 'documents')},
{_entries_sql('qv', 'qid', TOKENS.format('question'), 'questions')},
dn AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM dv GROUP BY 1), qn AS (SELECT qid, sqrt(sum(v * v)) AS norm FROM qv GROUP BY 1),
dots AS (SELECT qid, doc_id, sum(dv.v * qv.v) AS dot FROM qv JOIN dv USING (pos) GROUP BY ALL),
dist AS (SELECT qid, doc_id, CASE WHEN dn.norm > 0 THEN 1 - coalesce(dot, 0) / (dn.norm * qn.norm) END AS dist
  FROM qn CROSS JOIN documents LEFT JOIN dn USING (doc_id) LEFT JOIN dots USING (qid, doc_id)),
sem AS (SELECT qid, doc_id, dist, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9) NULLS LAST, doc_id) - 1 AS pos FROM dist)"""

CENTROID_CTE = """e AS (SELECT label, unnest(embedding)::double AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c0 AS (SELECT label, i, avg(v) AS v FROM e GROUP BY ALL), c AS (SELECT label AS qid, list(v ORDER BY i) AS centre FROM c0 GROUP BY 1),
d AS (SELECT qid, vec_id AS doc_id, list_cosine_distance(embedding::double[], centre) AS dist, label FROM c, embeddings),
near AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 9), doc_id) - 1 AS pos FROM d)"""


def merged_sql(num_chunks: int, k: int) -> str:
    return f"""merged AS (SELECT qid, doc_id, 'semantic' AS origin, CASE WHEN pos < {k} THEN pos ELSE pos + {k} END AS pos FROM sem WHERE pos < {num_chunks}
UNION ALL SELECT qid, doc_id, 'lexical', {k} + pos FROM lex WHERE pos < {k})"""


RERANKED_CTE = f"""ctx AS (SELECT qid, pos, doc_id, text, source, lang FROM merged JOIN docs USING (doc_id)),
pred AS (SELECT qid, {guessed_language_sql('question')} AS predicted FROM questions),
reranked AS (SELECT qid, doc_id, text, source, row_number() OVER (PARTITION BY qid ORDER BY (predicted <> 'other' AND lang <> predicted), pos) - 1 AS pos
  FROM ctx JOIN pred USING (qid))"""
HYBRID_CTE = f"{BM25_CTE}, {SEMANTIC_CTE}, {merged_sql(5, 2)}"
RETRIEVED_CTE = f"{HYBRID_CTE}, {RERANKED_CTE}, final AS (SELECT * FROM reranked WHERE pos < 6)"

CONFIG = RetrievalConfig(num_chunks=5, lexical_search_k=2, rerank_k=6, tag_prefix=TAG_PREFIX)


# -- shared plans ------------------------------------------------------------------


def lexical_index(t):
    return lexical.build_lexical_index(t.texts)


def doc_vectors(t):
    return embed_chunks(t.texts.select("doc_id", "text")).select("doc_id", "embedding")


def embedded_questions(t):
    return embed_queries(t.questions)


def centroids(t):
    return mean_vectors(t.vectors, "label").select(F.col("label").cast("bigint").alias("qid"), "embedding")


def predictions(t):
    guess = guessed_language(bm25_query_tokens(F.col("question")))
    return t.questions.select("qid", guess.alias("predicted_tag"))


def contexts(t, config=CONFIG):
    return retrieve_contexts(embedded_questions(t), t.docs, doc_vectors(t), lexical_index(t), predictions(t), config)


# -- embedding ---------------------------------------------------------------------


@check(
    "embed_chunks",
    f"WITH {_entries_sql('dv', 'doc_id', TOKENS.format('text'), 'documents')} SELECT doc_id, pos, round(v, 6) AS value FROM dv",
)
def embed_chunks_check(t):
    entries = vector_entries(doc_vectors(t), "doc_id")
    return entries.select("doc_id", "pos", F.round(F.col("value").cast("double"), 6).alias("value"))


@check(
    "embed_queries",
    f"WITH {QUESTIONS_CTE}, {_entries_sql('qv', 'qid', TOKENS.format('question'), 'questions')} SELECT qid, pos, round(v, 6) AS value FROM qv",
)
def embed_queries_check(t):
    entries = vector_entries(embedded_questions(t), "qid")
    return entries.select("qid", "pos", F.round(F.col("value").cast("double"), 6).alias("value"))


# -- lexical -----------------------------------------------------------------------


@check(
    "bm25_stats",
    f"WITH {BM25_CTE} SELECT n AS n_docs, (SELECT count(*) FROM df) AS n_terms, cast(total AS bigint) AS total_length, round(avgdl, 6) AS avgdl, round(mean_idf, 6) AS mean_idf FROM st, m",
)
def bm25_stats(t):
    stats = lexical.bm25_stats(lexical.count_terms(lexical.tokenize_corpus(t.texts)))
    return stats.select("n_docs", "n_terms", "total_length", F.round("avgdl", 6).alias("avgdl"), F.round("mean_idf", 6).alias("mean_idf"))


@check("bm25_idf", f"WITH {BM25_CTE} SELECT w, df, round(idf, 6) AS idf FROM idf")
def bm25_idf(t):
    return lexical_index(t).terms.select("w", "df", F.round("idf", 6).alias("idf"))


@check(
    "postings_join",
    f"WITH {BM25_CTE} SELECT w, doc_id, tf, round(idf, 6) AS idf FROM tf JOIN idf USING (w) WHERE w IN (SELECT w FROM qt)",
)
def postings_join(t):
    asked = lexical.tokenize_queries(t.questions)
    return lexical.postings_join(lexical_index(t), asked).select("w", "doc_id", "tf", F.round("idf", 6).alias("idf"))


@check(
    "bm25_score",
    f"WITH {BM25_CTE} SELECT qid, count(*) FILTER (score <> 0) AS n_matched, round(sum(score), 4) AS total_score, round(max(score), 6) AS best_score FROM scored GROUP BY qid",
)
def bm25_score(t):
    scored = lexical.bm25_score(lexical_index(t), t.questions)
    return scored.select(
        "qid", "n_matched", F.round("total_score", 4).alias("total_score"), F.round("best_score", 6).alias("best_score")
    )


@check("lexical_topk", f"WITH {BM25_CTE} SELECT qid, pos, doc_id, round(score, 6) AS score FROM lex WHERE pos < 5")
def lexical_topk(t):
    best = lexical.lexical_topk(lexical_index(t), t.questions, 5)
    return best.select("qid", "pos", "doc_id", F.round("score", 6).alias("score"))


# -- semantic ----------------------------------------------------------------------


@check("semantic_topk", f"WITH {QUESTIONS_CTE}, {SEMANTIC_CTE} SELECT qid, pos, doc_id FROM sem WHERE pos < 5")
def semantic_topk_check(t):
    return semantic_topk(doc_vectors(t), embedded_questions(t), 5).select("qid", "pos", "doc_id")


@check(
    "semantic_topk_scored",
    f"WITH {CENTROID_CTE} SELECT qid::bigint AS qid, pos, doc_id, round(dist, 6) AS dist FROM near WHERE pos < 10",
)
def semantic_topk_scored(t):
    """From the stored index by cluster."""
    near = semantic_search(build_vector_index(t.vectors), centroids(t), 10)
    return near.select("qid", "pos", "doc_id", F.round("dist", 6).alias("dist"))


@check(
    "query_x_chunk",
    f"""WITH {CENTROID_CTE} SELECT qid::bigint AS qid, count(*) AS n, round(avg(dist), 6) AS mean_dist, round(min(dist), 6) AS min_dist, round(max(dist), 6) AS max_dist
FROM d GROUP BY qid""",
)
def query_x_chunk(t):
    s = distance_summary(t.vectors, centroids(t))
    return s.select("qid", "n", *[F.round(c, 6).alias(c) for c in ("mean_dist", "min_dist", "max_dist")])


@check(
    "ir_metrics",
    f"""WITH {CENTROID_CTE}, sizes AS (SELECT label::bigint AS qid, count(*) AS r FROM embeddings GROUP BY 1),
h AS (SELECT qid, pos, row_number() OVER (PARTITION BY qid ORDER BY pos) AS nth FROM near WHERE pos < 100 AND label = qid),
q AS (SELECT s.qid, r, {', '.join(f'count(*) FILTER (pos < {k}) AS h{k}' for k in (1, 3, 5, 10))}, min(pos) FILTER (pos < 10) AS first,
  sum(1 / log2(pos + 2)) FILTER (pos < 10) AS dcg, sum(nth / (pos + 1)) AS ap FROM sizes s LEFT JOIN h USING (qid) GROUP BY ALL),
v AS (SELECT *, list_sum(list_transform(range(least(r, 10)), lambda i: 1 / log2(i + 2))) AS ideal FROM q)
{' UNION ALL '.join(
    [f"SELECT 'accuracy@{k}' AS metric, round(avg((h{k} > 0)::int), 6) AS value FROM v" for k in (1, 3, 5, 10)]
    + [f"SELECT 'precision@{k}', round(avg(h{k} / {k}), 6) FROM v" for k in (1, 3, 5, 10)]
    + [f"SELECT 'recall@{k}', round(avg(h{k} / r), 6) FROM v" for k in (1, 3, 5, 10)]
    + ["SELECT 'mrr@10', round(avg(coalesce(1 / (first + 1), 0)), 6) FROM v",
       "SELECT 'ndcg@10', round(avg(coalesce(dcg / ideal, 0)), 6) FROM v",
       "SELECT 'map@100', round(avg(coalesce(ap / least(r, 100), 0)), 6) FROM v"])}""",
)
def ir_metrics_check(t):
    ranked = semantic_topk(t.vectors, centroids(t), 100)
    relevant = t.vectors.select(F.col("label").cast("bigint").alias("qid"), "doc_id")
    return ir_metrics(ranked, relevant).select("metric", F.round("value", 6).alias("value"))


# -- merge, rerank, retrieve ---------------------------------------------------------


@check("hybrid_merge", f"WITH {HYBRID_CTE} SELECT qid, pos, doc_id, origin FROM merged")
def hybrid_merge_check(t):
    semantic = semantic_topk(doc_vectors(t), embedded_questions(t), 5)
    return hybrid_merge(semantic, lexical.lexical_topk(lexical_index(t), t.questions, 2), 2)


def _tagged_lexical(t, k):
    best = lexical.lexical_topk(lexical_index(t), t.questions, k).drop("score")
    return attach_documents(best, t.docs.select("doc_id", url_tag(F.col("source"), TAG_PREFIX).alias("tag")))


@check(
    "rerank_by_tag",
    f"""WITH {BM25_CTE}, {RERANKED_CTE.replace('FROM merged', 'FROM (SELECT * FROM lex WHERE pos < 8)')} SELECT qid, pos, doc_id FROM reranked""",
)
def rerank_by_tag_check(t):
    return rerank_by_tag(_tagged_lexical(t, 8), predictions(t)).select("qid", "pos", "doc_id")


@check(
    "rerank_truncate",
    f"""WITH {BM25_CTE}, {RERANKED_CTE.replace('FROM merged', 'FROM (SELECT * FROM lex WHERE pos < 8)')} SELECT qid, pos, doc_id FROM reranked WHERE pos < 3""",
)
def rerank_truncate_check(t):
    return rerank_truncate(rerank_by_tag(_tagged_lexical(t, 8), predictions(t)), 3).select("qid", "pos", "doc_id")


@check(
    "retrieve",
    f"""WITH {RETRIEVED_CTE} SELECT qid, string_agg(doc_id::varchar, ',' ORDER BY pos) AS document_ids,
array_to_string(list_sort(list_distinct(list(source))), ' ') AS sources, sum(length(text))::bigint AS context_chars FROM final GROUP BY qid""",
)
def retrieve_check(t):
    rows = retrieve(embedded_questions(t), t.docs, doc_vectors(t), lexical_index(t), predictions(t), CONFIG)
    chars = F.aggregate("texts", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x))
    return rows.select(
        "qid",
        F.array_join(F.col("document_ids").cast("array<string>"), ",").alias("document_ids"),
        F.array_join("sources", " ").alias("sources"),
        chars.alias("context_chars"),
    )


@check(
    "distinct_sources",
    f"""WITH {BM25_CTE} SELECT qid, array_to_string(list_sort(list_distinct(list(lang || '/' || tag))), ' ') AS sources
FROM lex JOIN docs USING (doc_id) WHERE pos < 10 GROUP BY qid""",
)
def distinct_sources_check(t):
    best = lexical.lexical_topk(lexical_index(t), t.questions, 10)
    rows = attach_documents(best, t.docs.select("doc_id", F.concat_ws("/", "lang", "tag").alias("source")))
    return distinct_sources(rows).select("qid", F.array_join("sources", " ").alias("sources"))


@check(
    "build_user_prompt",
    f"""WITH {BM25_CTE} SELECT qid, substr('query: ' || any_value(question) || ', context: ' || cast(to_json(list(text ORDER BY pos)) AS varchar), 1, 4 * 500) AS prompt
FROM lex JOIN docs USING (doc_id) JOIN questions USING (qid) WHERE pos < 3 GROUP BY qid""",
)
def build_user_prompt(t):
    best = lexical.lexical_topk(lexical_index(t), t.questions, 3)
    rows = gather_contexts(t.questions, attach_documents(best, t.docs.select("doc_id", "text", "source")))
    return rows.select("qid", user_prompt(F.col("question"), F.col("texts"), 500).alias("prompt"))


REF_PAGE = "'https://docs.example.com/latest/' || lang || '/src' || cast(qid % 20 as string) || '.html'"
REFS_CTE = f"refs AS (SELECT qid, {REF_PAGE} AS page FROM (SELECT qid, {guessed_language_sql('question')} AS lang FROM questions))"


def reference_pages(t):
    guess = guessed_language(bm25_query_tokens(F.col("question")))
    return t.questions.withColumn("lang", guess).select("qid", F.expr(REF_PAGE).alias("source"))


SIZES = [1, 3, 5, 7, 9, 11, 13, 15]


@check(
    "num_chunks_sweep",
    f"""WITH {QUESTIONS_CTE}, {SEMANTIC_CTE}, {DOCS_CTE}, {REFS_CTE}, sizes AS (SELECT unnest({SIZES}) AS num_chunks),
h AS (SELECT num_chunks, r.qid, max((string_split(source, '#')[1] = page)::int) AS hit
  FROM refs r JOIN sem USING (qid) JOIN docs USING (doc_id), sizes WHERE pos < num_chunks GROUP BY ALL)
SELECT num_chunks, round(avg(hit), 6) AS retrieval_score FROM h GROUP BY 1""",
)
def num_chunks_sweep_check(t):
    ranked = semantic_topk(doc_vectors(t), embedded_questions(t), max(SIZES))
    placed = attach_documents(ranked.drop("dist"), t.docs.select("doc_id", "source"))
    swept = num_chunks_sweep(placed, reference_pages(t), SIZES)
    return swept.select("num_chunks", F.round("retrieval_score", 6).alias("retrieval_score"))


@check(
    "retrieved_hit_semi",
    f"""WITH {BM25_CTE}, {REFS_CTE} SELECT qid AS pos, page AS source FROM refs r
WHERE EXISTS (SELECT 1 FROM lex JOIN docs USING (doc_id) WHERE lex.qid = r.qid AND lex.pos < 10 AND string_split(source, '#')[1] = r.page)""",
)
def retrieved_hit_semi_check(t):
    best = lexical.lexical_topk(lexical_index(t), t.questions, 10)
    placed = attach_documents(best.select("qid", "doc_id"), t.docs.select("doc_id", "source"))
    return retrieved_hit_semi(
        reference_pages(t).withColumnRenamed("qid", "pos"), placed.withColumnRenamed("qid", "pos")
    )
