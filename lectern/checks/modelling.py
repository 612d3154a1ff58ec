"""Checks of fitted models (on rows held back) and of model calls.

The calls go to models that count characters, so that SQL can tell the answers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.checks.evaluating import GAPS_CTE, _generated, _references
from lectern.checks.registry import DOC_URL, QA_CTE, check, guessed_language
from lectern.checks.searching import (
    BM25_CTE,
    CONFIG,
    REFS_CTE,
    RETRIEVED_CTE,
    SEMANTIC_CTE,
    contexts,
    doc_vectors,
    embedded_questions,
    lexical_index,
    merged_sql,
    predictions,
    reference_pages,
)
from lectern.checks.texts import STRIP
from lectern.functions.prompts import messages, user_prompt
from lectern.functions.text import bm25_query_tokens
from lectern.operators import classifier
from lectern.operators.classifier import route
from lectern.operators.embedding import embed_queries
from lectern.operators.generation import batch_generate
from lectern.operators.ranking import split_stratified
from lectern.operators.sections import extract_sections
from lectern.plans.answering import (
    answer_batch,
    answer_conversations,
    answer_routed,
    answer_with_given_context,
    generate_qa_per_chunk,
    generate_question_per_section,
)
from lectern.plans.evaluating import judge_answers, run_experiments
from lectern.plans.retrieval import RetrievalConfig, retrieve
from lectern.session import materialize, scratch_path


def tag_rows(t, part):
    """Documents of one part of the split that is stratified by language."""
    return split_stratified(t.texts.select("doc_id", "text", "lang"), "lang", "doc_id").where(F.col("part") == part).drop("part")


def tag_model(t):
    """Fitted on ``train``; every check predicts ``test`` or the questions."""
    return classifier.train_tag_classifier(tag_rows(t, "train"), tag="lang")


TEST_CTE = """held AS (SELECT doc_id, lang, text, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id || '#1234'), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents),
test AS (SELECT doc_id, lang, text FROM held WHERE r <= ceil(0.2 * n)), langs AS (SELECT DISTINCT lang FROM documents)"""


@check(
    "train_tag_classifier",
    f"""WITH {TEST_CTE} SELECT doc_id, (SELECT string_agg(lang, ',' ORDER BY lang) FROM langs) AS labels, 1.0::double AS total, true AS better_than_majority FROM test""",
)
def train_tag_classifier(t):
    """Rows, label set and sums of probabilities as SQL tells them; accuracy against the share of the most frequent language."""
    path = scratch_path(t.spark, "tag-model")
    classifier.save_model(tag_model(t), path)
    test = tag_rows(t, "test")
    found = materialize(classifier.predict_probabilities(classifier.load_model(path), test), "predicted")
    best = F.get("labels", F.array_position("probabilities", F.array_max("probabilities")).cast("int") - 1)
    right = found.agg(F.avg((best == F.col("lang")).cast("double")).alias("accuracy"))
    majority = test.groupBy("lang").count().agg((F.max("count") / F.sum("count")).alias("majority"))
    total = F.round(F.aggregate("probabilities", F.lit(0.0), lambda x, y: x + y), 6).alias("total")
    judged = right.crossJoin(majority).select((F.col("accuracy") > F.col("majority")).alias("better_than_majority"))
    return found.select("doc_id", F.array_join("labels", ",").alias("labels"), total).crossJoin(F.broadcast(judged))


@check("predict_tag", f"WITH {TEST_CTE} SELECT item_id AS qid, true AS known FROM benchmark")
def predict_tag(t):
    names = F.array(*[F.lit(x) for x in ("de", "en", "es", "fr", "other")])
    found = classifier.predict_tag(tag_model(t), t.questions, text="question")
    return found.select("qid", F.array_contains(names, F.col("predicted_tag")).alias("known"))


@check(
    "predict_proba_ranked",
    f"WITH {TEST_CTE} SELECT doc_id, count(*) AS n_labels, true AS descending, 1.0::double AS total FROM test, langs GROUP BY doc_id",
)
def predict_proba_ranked(t):
    ranked = classifier.predict_proba_ranked(tag_model(t), tag_rows(t, "test"), "doc_id")
    order = F.array_sort(F.collect_list(F.struct("rank", "probability")))["probability"]
    lists = ranked.groupBy("doc_id").agg(F.count("*").alias("n_labels"), order.alias("p"), F.round(F.sum("probability"), 6).alias("total"))
    return lists.select("doc_id", "n_labels", (F.col("p") == F.reverse(F.array_sort("p"))).alias("descending"), "total")


@check(
    "minimum_functionality_checks",
    f"WITH {TEST_CTE} SELECT lang AS tag, count(*) AS n_expected, true AS mostly_met FROM test GROUP BY lang",
)
def minimum_functionality_checks(t):
    """Expectations are the languages of the documents held back."""
    expected = tag_rows(t, "test").select("doc_id", F.col("text").alias("question"), F.col("lang").alias("tag"))
    failed = classifier.minimum_functionality_checks(tag_model(t), expected).groupBy("tag").agg(F.count("*").alias("n_failed"))
    met = F.coalesce("n_failed", F.lit(0)) * 4 < F.col("n_expected")
    return expected.groupBy("tag").agg(F.count("*").alias("n_expected")).join(failed, "tag", "left").select("tag", "n_expected", met.alias("mostly_met"))


def router_rows(t, part):
    labelled = t.texts.join(t.labels, "doc_id").select("doc_id", F.col("text").alias("question"), F.col("quality").alias("target"))
    return split_stratified(labelled, "target", "doc_id").where(F.col("part") == part).drop("part")


def router(t):
    return classifier.train_router(router_rows(t, "train"))


ROUTER_CTE = """held AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id || '#1234'), doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n FROM labels),
test AS (SELECT doc_id, quality FROM held WHERE r <= ceil(0.2 * n))"""


@check("train_router", f"WITH {ROUTER_CTE} SELECT doc_id, true AS consistent, true AS no_worse_than_majority FROM test")
def train_router(t):
    """Routes of held-back rows; accuracy against the share of the most frequent target."""
    path = scratch_path(t.spark, "router")
    classifier.save_model(router(t), path)
    found = classifier.route_queries(classifier.load_model(path), router_rows(t, "test"), "open", "closed")
    found = materialize(found, "routed")
    right = F.sum((F.col("routed") == F.col("target")).cast("long"))
    sizes = found.groupBy("target").agg(F.count("*").alias("n"), right.alias("right"))
    judged = sizes.agg((F.sum("right") >= F.max("n")).alias("no_worse_than_majority"))
    consistent = F.col("llm") == route(F.col("routed"), "open", "closed")
    return found.select("doc_id", consistent.alias("consistent")).crossJoin(F.broadcast(judged))


@check("route_queries", "SELECT item_id AS qid, true AS consistent FROM benchmark")
def route_queries(t):
    found = classifier.route_queries(router(t), t.questions, "open", "closed")
    return found.select("qid", ((F.col("llm") == "open") == (F.col("routed") == 1)).alias("consistent"))


def counting_model(form: str = "{n} characters"):
    """Factory of a model whose answer is ``form`` with the length ``n`` of the last message, ``llm`` and ``max_tokens``."""

    def factory():
        def answer(asked: list[dict], llm=None, max_tokens=None, temperature=0.0) -> str:
            n = len(asked[-1]["content"])
            told = {"{n}": n, "{n%5}": n % 5, "{n%6}": n % 6, "{all}": sum(len(m["content"]) for m in asked), "{llm}": llm, "{max}": max_tokens}
            out = form
            for name, value in told.items():
                out = out.replace(name, str(value))
            return out

        return answer

    return factory


NAMED_FORM = "{n} characters for {llm}, at most {max}"
REFERENCE_FORM = '{"answer": "{n} characters", "score": {n%6}, "reasoning": "counted"}'
JUDGE_FORM = "{n%5}\n\ncounted"
# Characters of the prompt that fit into half of a context of 4096 tokens.
PROMPT_CHARS = 8192


def prompt_sql(question: str, texts: str) -> str:
    return f"length(substr('query: ' || {question} || ', context: ' || cast(to_json({texts}) AS varchar), 1, {PROMPT_CHARS}))"


def record_sql(question: str, generated: str, reference: str) -> str:
    record = f"{{'question': {question}, 'generated_answer': {generated}, 'reference_answer': {reference}}}"
    return f"length(substr(cast(to_json({record}) AS varchar), 1, 4 * 8192))"


@check(
    "batch_generate",
    f"WITH {QA_CTE} SELECT pos, {prompt_sql('question', '[answer]')} || ' characters' AS answer, 1 AS attempts, cast(NULL AS varchar) AS error FROM qa",
)
def batch_generate_check(t):
    prompt = F.substring(user_prompt(F.col("question"), F.array("answer")), 1, PROMPT_CHARS)
    asked = t.qa.select("pos", messages(F.lit("Be succinct."), F.lit(""), prompt).alias("messages"))
    return batch_generate(asked, counting_model(), retry_interval=0)


@check(
    "answer_batch",
    f"""WITH {RETRIEVED_CTE} SELECT qid, any_value(question) AS question, {prompt_sql('any_value(question)', 'list(text ORDER BY pos)')} || ' characters for open, at most 2048' AS answer,
'open' AS llm, count(*) AS n_documents FROM final JOIN questions USING (qid) GROUP BY qid""",
)
def answer_batch_check(t):
    found = retrieve(embedded_questions(t), t.docs, doc_vectors(t), lexical_index(t), predictions(t), CONFIG)
    answered = answer_batch(found, counting_model(NAMED_FORM), "open", retry_interval=0)
    return answered.select("qid", "question", "answer", "llm", F.size("document_ids").alias("n_documents"))


# Questions of even length go to the open model; contexts are 32,768 and 8,192 tokens long, and half of them is the prompt's.
OPEN, CLOSED = "mistralai/Mixtral-8x7B-Instruct-v0.1", "gpt-4"
ROUTED_CTE = f"""{RETRIEVED_CTE}, asked AS (SELECT qid, any_value(question) AS question, length(any_value(question)) % 2 = 0 AS open,
  string_agg(doc_id::varchar, ',' ORDER BY pos) AS document_ids, 'query: ' || any_value(question) || ', context: ' || cast(to_json(list(text ORDER BY pos)) AS varchar) AS prompt
  FROM final JOIN questions USING (qid) GROUP BY qid),
routed AS (SELECT qid, question, document_ids, CASE WHEN open THEN '{OPEN}' ELSE '{CLOSED}' END AS llm,
  length(substr(prompt, 1, CASE WHEN open THEN 65536 ELSE 16384 END)) || ' characters for ' || CASE WHEN open THEN '{OPEN}, at most 16384' ELSE '{CLOSED}, at most 4096' END AS answer FROM asked)"""


def by_length(questions):
    return questions.withColumn("llm", route((F.length("question") % 2 == 0).cast("int"), OPEN, CLOSED))


def routed_answers(questions, t, vectors, index):
    """Retrieve, route, answer."""
    tags = questions.select("qid", guessed_language(bm25_query_tokens(F.col("question"))).alias("predicted_tag"))
    found = retrieve(embed_queries(questions), t.docs, vectors, index, tags, CONFIG)
    return answer_routed(found, by_length, counting_model(NAMED_FORM), retry_interval=0)


@check("answer_routed", f"WITH {ROUTED_CTE} SELECT qid, question, document_ids, llm, answer FROM routed")
def answer_routed_check(t):
    answered = routed_answers(t.questions, t, doc_vectors(t), lexical_index(t))
    ids = F.array_join(F.col("document_ids").cast("array<string>"), ",").alias("document_ids")
    return answered.select("qid", "question", ids, "llm", "answer")


@check(
    "answer_conversations",
    f"""SELECT conv_id, count(*) AS n_messages, CASE WHEN count(*) = 1 THEN 'single' ELSE '{OPEN}' END AS llm, CASE WHEN count(*) = 1 THEN 1 ELSE 0 END AS n_documents,
CASE WHEN count(*) = 1 THEN upper(min_by(text, turn)) ELSE sum(length(text)) || ' characters for {OPEN}, at most 16384' END AS answer FROM conversations GROUP BY conv_id""",
)
def answer_conversations_check(t):
    """Single messages are answered from a table of their own; longer conversations by the open model from all messages."""

    def look_up(queries):
        return queries.select(
            "qid", "question", F.array(F.lit("s")).alias("sources"), F.array("qid").alias("document_ids"), F.upper("question").alias("answer"), F.lit("single").alias("llm")
        )

    form = NAMED_FORM.replace("{n}", "{all}")
    answered = answer_conversations(t.turns, look_up, counting_model(form), OPEN, retry_interval=0)
    counts = t.turns.groupBy("conv_id").agg(F.count("*").alias("n_messages"))
    return answered.join(counts, "conv_id").select("conv_id", "n_messages", "llm", F.size("document_ids").alias("n_documents"), "answer")


def sourced_questions(t):
    """One question per labelled document, its source being the document's own section."""
    pages = t.documents.select("doc_id", F.expr(DOC_URL).alias("_url"))
    anchor = F.concat(F.lit("#d"), F.col("doc_id").cast("string"))
    asked = F.concat(F.lit("About "), F.col("doc_id").cast("string"))
    return t.labels.select("doc_id").join(pages, "doc_id").select(
        "doc_id", asked.alias("question"), F.concat("_url", anchor).alias("source")
    )


@check(
    "answer_with_given_context",
    f"""WITH n AS (SELECT d.doc_id, {DOC_URL} || '#d' || d.doc_id AS source, length(substr('query: About ' || d.doc_id || ', context: ' || lang || text || n_chars, 1, {PROMPT_CHARS})) AS n
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
SELECT doc_id, 'About ' || doc_id AS question, source, n || ' characters' AS answer, (n % 6)::double AS score, 'counted' AS reasoning FROM n""".replace(
        "cast(doc_id as string)", "cast(d.doc_id as string)"
    ),
)
def answer_with_given_context_check(t):
    return answer_with_given_context(sourced_questions(t), t.doc_pages, counting_model(REFERENCE_FORM), retry_interval=0)


SECTION_SQL = f"""SELECT {DOC_URL} || '#d' || doc_id AS source, lang || chr(10) || {STRIP.format('text')} || chr(10) || 'c' AS text
FROM documents UNION ALL SELECT {DOC_URL} || '#d' || doc_id || '-len', cast(n_chars AS varchar) FROM documents"""


@check(
    "generate_qa_per_chunk",
    f"SELECT source, 0 AS entry_pos, 'How long?' AS question, length(substr('context: ' || text, 1, {PROMPT_CHARS})) || ' characters' AS answer FROM ({SECTION_SQL})",
)
def generate_qa_per_chunk_check(t):
    sections = extract_sections(t.doc_pages).select("source", "text")
    pairs, _ = generate_qa_per_chunk(sections, counting_model("How long?\n{n} characters"), retry_interval=0)
    return pairs


@check(
    "generate_question_per_section",
    f"SELECT source, 'What is said in ' || length(substr('context: ' || text, 1, {PROMPT_CHARS})) || ' characters?' AS question FROM ({SECTION_SQL})",
)
def generate_question_per_section_check(t):
    sections = extract_sections(t.doc_pages).select("source", "text")
    return generate_question_per_section(sections, counting_model("\n What is said in {n} characters?\n"), retry_interval=0)


@check(
    "judge_answers",
    f"""WITH {QA_CTE}, {GAPS_CTE} SELECT pos, same_question, CASE WHEN same_question THEN ({record_sql('question', 'answer', 'reference_answer')} % 5)::double END AS score,
CASE WHEN same_question THEN 'counted' END AS reasoning, false AS parse_error, false AS call_failed FROM paired""",
)
def judge_answers_check(t):
    """References and answers with gaps on both sides and with other questions."""
    references = _references(t).withColumnRenamed("reference_answer", "answer")
    generated = _generated(t)
    judged = judge_answers(references, generated, counting_model(JUDGE_FORM), retry_interval=0)
    return judged.select("pos", "same_question", "score", "reasoning", "parse_error", "call_failed")


SWEEP = (0, 1, 3, 5)


@check(
    "run_experiment",
    f"""WITH {BM25_CTE}, {SEMANTIC_CTE}, {merged_sql(5, 1)}, {REFS_CTE}, sizes AS (SELECT unnest({list(SWEEP)}) AS n),
ctx AS (SELECT n, qid, list(text ORDER BY pos) AS texts, list(string_split(source, '#')[1]) AS pages
  FROM merged JOIN docs USING (doc_id), sizes WHERE pos < n GROUP BY ALL),
a AS (SELECT s.n, q.qid, question, page, coalesce(list_contains(pages, page), false) AS hit,
  {prompt_sql('question', "coalesce(texts, []::varchar[])")} || ' characters' AS answer
  FROM questions q CROSS JOIN sizes s JOIN refs USING (qid) LEFT JOIN ctx ON ctx.n = s.n AND ctx.qid = q.qid),
j AS (SELECT *, {record_sql('question', 'answer', 'question')} % 5 AS score FROM a)
SELECT 'num-chunks-' || n AS experiment_name, round(avg(hit::int), 6) AS retrieval_score, round(avg(score) FILTER (score <> 0), 6) AS quality_score,
count(*) AS n_questions, count(*) FILTER (score <> 0) AS n_scored FROM j GROUP BY n""",
)
def run_experiment_check(t):
    ranked = contexts(t, RetrievalConfig(num_chunks=5, lexical_search_k=1, use_reranking=False))
    references = reference_pages(t).join(t.questions, "qid").withColumn("answer", F.col("question"))
    configs = [{"experiment_name": f"num-chunks-{n}", "num_chunks": n, "llm": "open"} for n in SWEEP]
    scores, _ = run_experiments(
        ranked, t.questions, references, configs, counting_model(), counting_model(JUDGE_FORM), retry_interval=0
    )
    rounded = [F.round(c, 6).alias(c) for c in ("retrieval_score", "quality_score")]
    return scores.select("experiment_name", *rounded, "n_questions", "n_scored")
