"""Source, sink and streaming checks: written to a fresh scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.checks.modelling import ROUTED_CTE, SECTION_SQL, routed_answers
from lectern.checks.registry import DOC_HTML, DOC_SOURCE, DOC_URL, QA_CTE, TOKENS, check
from lectern.checks.searching import doc_vectors, lexical_index
from lectern.checks.texts import CHUNK_SQL, SQL_BLANKED
from lectern.checks.evaluating import SCORES_SQL, experiment_table
from lectern.operators.chunking import chunk_fixed
from lectern.operators.embedding import HashedWords, embed_chunks
from lectern.operators.sections import extract_sections, page_blocks
from lectern.session import scratch_path
from lectern.sources import index_store, records
from lectern.sources.html_files import scan_html_pages, write_html_pages
from lectern.streaming import jobs

DIM = 64


@check(
    "scan_html_pages",
    "SELECT page_id, 'https://site.example/page_id=' || page_id || '/' || page_id || '.html' AS url, html || chr(10) AS html FROM pages",
)
def scan_html_pages_check(t):
    """Every page becomes a file of its own, ``<page_id>.html``, and the folder is scanned."""
    folder = scratch_path(t.spark, "site.example")
    write_html_pages(t.pages.select(F.format_string("page_id=%1$d/%1$d", "page_id").alias("name"), "html"), folder)
    files = scan_html_pages(t.spark, folder, "site.example")
    return files.select(F.regexp_extract("path", r"/(\d+)\.html$", 1).cast("bigint").alias("page_id"), "url", "html")


def embedded_documents(t):
    rows = t.texts.select(F.col("doc_id").alias("id"), "text", F.expr(DOC_SOURCE).alias("source"))
    return embed_chunks(rows, HashedWords(DIM))


INDEX_SQL = f"SELECT doc_id AS id, text, {DOC_SOURCE} AS source FROM documents"


def _index_rows(rows):
    return rows.select("id", "text", "source")


@check("write_index", f"SELECT id, text, source, {DIM} AS dim FROM ({INDEX_SQL})")
def write_index(t):
    path = scratch_path(t.spark, "index")
    index_store.write_index(embedded_documents(t), path, DIM)
    stored = t.spark.read.parquet(path)
    return stored.select("id", "text", "source", F.size("embedding").alias("dim"))


@check("reset_index", f"SELECT 0::bigint AS n_after_reset, (SELECT count(*) FROM documents) AS n_after_load")
def reset_index(t):
    path = scratch_path(t.spark, "index")
    index_store.write_index(embedded_documents(t), path, DIM)
    index_store.reset_index(t.spark, path, DIM)
    emptied = index_store.read_index_chunks(t.spark, path).count()
    index_store.write_index(embedded_documents(t), path, DIM)
    loaded = index_store.read_index_chunks(t.spark, path)
    return loaded.agg(F.lit(emptied).cast("bigint").alias("n_after_reset"), F.count("*").alias("n_after_load"))


@check("load_or_build_index", INDEX_SQL)
def load_or_build_index(t):
    root = scratch_path(t.spark, "indexes")

    def load(build):
        return index_store.load_or_build_index(t.spark, root, "local/hashed-words", DIM, 700, 50, build)

    load(lambda: embedded_documents(t))

    def no_second_build():
        raise AssertionError("the stored index was not used")

    return _index_rows(load(no_second_build))


@check("read_index_chunks", f"SELECT doc_id AS id, text, {DOC_SOURCE} AS source FROM documents")
def read_index_chunks(t):
    path = scratch_path(t.spark, "index")
    index_store.write_index(embedded_documents(t), path, DIM)
    return index_store.read_index_chunks(t.spark, path)


@check("write_lexical_index", f"SELECT doc_id, len({TOKENS.format('text')}) AS dl FROM documents")
def write_lexical_index(t):
    from lectern.operators import lexical

    path = scratch_path(t.spark, "lexical")
    lexical.write_lexical_index(lexical.build_lexical_index(t.texts), path)
    return lexical.read_lexical_index(t.spark, path).docs.select("doc_id", "dl")


@check(
    "count_rows",
    f"""SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'chunks', count(*) FROM ({CHUNK_SQL}) UNION ALL
SELECT 'blocks', sum(len(regexp_split_to_array({SQL_BLANKED.format('html')}, '(?i)<p(?:\\s[^>]*)?>')) - 1)::bigint FROM pages""",
)
def count_rows(t):
    chunks = chunk_fixed(t.texts.select("doc_id", "text"), 700, 50)
    return index_store.count_rows(documents=t.documents, chunks=chunks, blocks=page_blocks(t.page_texts))


@check("scan_questions_jsonl", "SELECT text AS question, 'item-' || item_id AS source FROM benchmark")
def scan_questions_jsonl(t):
    path = scratch_path(t.spark, "questions")
    source = F.concat(F.lit("item-"), F.col("qid").cast("string"))
    t.questions.select("question", source.alias("source")).write.json(path)
    return records.scan_questions_jsonl(t.spark, path)


@check("write_qa_pairs", f"WITH {QA_CTE} SELECT question, source, answer FROM qa")
def write_qa_pairs(t):
    path = scratch_path(t.spark, "pairs")
    records.write_qa_pairs(t.qa.select("question", "source", "answer"), path)
    return records.read_qa_pairs(t.spark, path)


def _responses(t):
    return t.qa.select(
        "experiment_name", "pos", "question", "sources", F.array("conv_id", "turn").alias("document_ids"), "answer",
        F.col("experiment_name").alias("llm"),
    )


RESPONSE_SQL = f"""WITH {QA_CTE} SELECT experiment_name, pos, question, array_to_string(sources, ' ') AS sources, conv_id || ',' || turn AS document_ids, answer, experiment_name AS llm FROM qa"""


def _flat(rows):
    return rows.select(
        "experiment_name", "pos", "question", F.array_join("sources", " ").alias("sources"),
        F.array_join(F.col("document_ids").cast("array<string>"), ",").alias("document_ids"), "answer", "llm",
    )


@check("scan_responses_json", RESPONSE_SQL)
def scan_responses_json(t):
    path = scratch_path(t.spark, "responses")
    records.write_responses(_responses(t), t.experiment_configs, path, nested=True)
    return _flat(records.scan_responses_json(t.spark, path, lines=True))


@check("write_responses", RESPONSE_SQL)
def write_responses(t):
    path = scratch_path(t.spark, "responses")
    records.write_responses(_responses(t), t.experiment_configs, path)
    return _flat(records.read_results(t.spark, path)[0])


@check("write_references", f"WITH {QA_CTE} SELECT pos, question, source, reference_answer AS answer, score, raw AS reasoning FROM qa")
def write_references(t):
    path = scratch_path(t.spark, "references")
    rows = t.qa.select("pos", "question", "source", F.col("reference_answer").alias("answer"), "score", F.col("raw").alias("reasoning"))
    records.write_references(rows, path)
    return records.read_references(t.spark, path)


def _evaluated(t):
    return t.qa.select(
        "experiment_name", "pos", "question", F.col("answer").alias("generated_answer"), "reference_answer", "score",
        F.col("raw").alias("reasoning"), "sources",
    )


def _write_evaluation(t):
    path = scratch_path(t.spark, "evaluations")
    configs = t.experiment_configs.join(experiment_table(t), "experiment_name")
    records.write_evaluation(_evaluated(t), configs, path, nested=True)
    return path


@check("write_evaluation", f"WITH {QA_CTE} SELECT experiment_name, pos, score, reference_answer, answer AS generated_answer FROM qa")
def write_evaluation(t):
    rows = records.scan_evaluation_results(t.spark, _write_evaluation(t), lines=True)
    return rows.select("experiment_name", "pos", "score", "reference_answer", "generated_answer")


@check("scan_evaluations_dir", f"WITH {QA_CTE} SELECT experiment_name, CAST(NULL AS VARCHAR) AS evaluator, retrieval_score, quality_score FROM ({SCORES_SQL})")
def scan_evaluations_dir(t):
    return records.scan_evaluations_dir(t.spark, _write_evaluation(t), lines=True)


LOG_SQL = f"WITH {QA_CTE} SELECT question AS query, conv_id || ',' || turn AS document_ids, experiment_name AS llm, answer, true AS timed FROM qa"


def _log_rows(log):
    return log.select(
        "query", F.array_join(F.col("document_ids").cast("array<string>"), ",").alias("document_ids"), "llm", "answer",
        F.col("time").isNotNull().alias("timed"),
    )


@check("append_answer_log", LOG_SQL)
def append_answer_log(t):
    path = scratch_path(t.spark, "log")
    answers = _responses(t)
    even = F.col("pos") % 2 == 0
    records.append_answer_log(answers.where(even), path)
    records.append_answer_log(answers.where(~even), path)
    return _log_rows(t.spark.read.parquet(path))


# -- streams -----------------------------------------------------------------------


@check("stream_answer_queries", f"WITH {ROUTED_CTE} SELECT question AS query, document_ids, llm, answer, true AS timed FROM routed")
def stream_answer_queries(t):
    """Questions arrive as files; each micro-batch is retrieved for, routed, answered and logged."""
    inbox, log, checkpoint = (scratch_path(t.spark, n) for n in ("inbox", "log", "checkpoint"))
    t.questions.write.parquet(inbox)
    vectors, index = doc_vectors(t), lexical_index(t)

    def answer(batch):
        return routed_answers(batch, t, vectors, index)

    stream = t.spark.readStream.schema(t.questions.schema).parquet(inbox)
    jobs.stream_answer_queries(stream, answer, log, checkpoint).awaitTermination()
    return _log_rows(t.spark.read.parquet(log))


EDITED_SQL = f"""SELECT CASE WHEN doc_id % 3 = 0 THEN 'short ' || doc_id WHEN doc_id % 3 = 1 THEN text || ' edited' ELSE text END AS text, * EXCLUDE (text) FROM documents"""


@check(
    "stream_index_pages",
    f"""WITH edited AS ({EDITED_SQL}), s AS ({SECTION_SQL.replace('FROM documents', 'FROM edited')}),
c AS (SELECT source, text, unnest(range(0, greatest(cast(floor((length(text) - 51) / 650) AS bigint), 0) + 1)) AS i FROM s)
SELECT source, i AS chunk_pos, substr(text, i * 650 + 1, 700) AS text, {DIM} AS dim, 1 AS n_same_id FROM c""",
)
def stream_index_pages(t):
    """All pages, then again with a third of them shortened, a third edited and a third as they were, in several micro-batches."""
    inbox, index, checkpoint = (scratch_path(t.spark, n) for n in ("inbox", "index", "checkpoint"))
    third = F.col("doc_id") % 3
    changed = F.when(third == 0, F.concat(F.lit("short "), F.col("doc_id").cast("string"))).when(third == 1, F.concat("text", F.lit(" edited")))
    edited = t.texts.withColumn("text", F.coalesce(changed, F.col("text"))).select(F.expr(DOC_URL).alias("url"), F.expr(DOC_HTML).alias("html"))

    def chunk(batch):
        return chunk_fixed(extract_sections(batch).withColumnRenamed("pos", "section_pos"), 700, 50)

    def encode(chunks):
        return embed_chunks(chunks, HashedWords(DIM))

    for pages in (t.doc_pages.select("url", "html"), edited):
        pages.coalesce(3).write.mode("append").parquet(inbox)
        stream = t.spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 2).parquet(inbox)
        jobs.stream_index_pages(stream, chunk, encode, index, checkpoint, buckets=8).awaitTermination()
    stored = jobs.read_streamed_index(t.spark, index).select("id", "source", "chunk_pos", "text", F.size("embedding").alias("dim"))
    same = stored.groupBy("id").agg(F.count("*").cast("int").alias("n_same_id"))
    return stored.join(same, "id").select("source", "chunk_pos", "text", "dim", "n_same_id")


@check(
    "feedback_rollup",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, event_type, count(*) AS n, round(avg(value), 6) AS mean_value FROM events GROUP BY ALL""",
)
def feedback_rollup(t):
    rolled = jobs.feedback_rollup(t.events)
    return rolled.select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n", F.round("mean_value", 6).alias("mean_value")
    )
