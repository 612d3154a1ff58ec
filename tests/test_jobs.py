import json

import pytest
from pyspark.sql import functions as F

from lectern.functions.prompts import messages
from lectern.operators import classifier
from lectern.operators.embedding import HashedWords, embed_chunks, embed_queries, encoder_of
from lectern.operators.generation import batch_generate, extractive_model, overlap_judge, question_writer
from lectern.operators.ledger import read_ledger
from lectern.operators.lexical import build_lexical_index
from lectern.operators.chunking import chunk_sections
from lectern.operators.sections import extract_sections
from lectern.plans.answering import answer_batch, answer_with_given_context, generate_qa_per_chunk
from lectern.plans.evaluating import judge_answers, run_experiment_grid, run_experiments
from lectern.plans.indexing import build_index
from lectern.plans.retrieval import RetrievalConfig, retrieve, retrieve_contexts
from lectern.sources import index_store, records
from lectern.sources import html_files
from lectern.sources.html_files import scan_html_pages
from lectern.streaming import jobs
from tests.conftest import rows

TOPICS = {"tune": "search trials and pick the best checkpoint", "serve": "replicas answer requests behind a proxy", "data": "batches of rows are mapped and shuffled"}


def page(topic, text):
    return f"<html><body><section id='{topic}-top'><h1>{topic}</h1><p>{text}. More on {topic}.</p></section></body></html>"


@pytest.fixture(scope="module")
def pages(spark):
    data = [(f"https://d.example.com/latest/{t}/index.html", page(t, x)) for t, x in TOPICS.items()]
    return spark.createDataFrame(data, "url string, html string").cache()


# -- sources -----------------------------------------------------------------------


def test_html_files(spark, tmp_path):
    folder = tmp_path / "d.example.com" / "deep.html"
    folder.mkdir(parents=True)
    (folder / "a.html").write_text("<p>a\nb</p>", encoding="utf-8")
    (folder / "b.txt").write_text("no")
    (tmp_path / "d.example.com" / "c.html").write_text("c")
    found = rows(scan_html_pages(spark, str(tmp_path), "d.example.com").select("url", "html"))
    assert found == [("https://d.example.com/c.html", "c"), ("https://d.example.com/deep.html/a.html", "<p>a\nb</p>")]


def test_single_quoted_question_lines(spark, tmp_path):
    (tmp_path / "q.jsonl").write_text("{'question': 'a \"b\"?', 'source': 'u#x'}\n{'question': \"it's\", 'source': 'v'}\n")
    assert rows(records.scan_questions_jsonl(spark, str(tmp_path / "q.jsonl"))) == [('a "b"?', "u#x"), ("it's", "v")]


def test_unreadable_question_lines_are_rejects(spark, tmp_path):
    lines = ['{"question": "a", "source": "u"}', "{'question': 'b', 'source'", "plain words", "", '{"source": "v"}', '{"question": null}', '{"question": "c"}', '["x"]']
    path = tmp_path / "q.jsonl"
    path.write_text("\n".join(lines) + "\n")
    assert rows(records.scan_questions_jsonl(spark, str(path))) == [("a", "u"), ("c", None)]
    rejected = records.scan_rejected_lines(spark, str(path))
    assert rejected.count() == 5
    assert rows(rejected.select("reason", "line", "source")) == sorted(
        [("no record", lines[1], None), ("no record", lines[2], None), ("no record", lines[7], None), ("no question", None, "v"), ("no question", None, None)],
        key=lambda r: tuple((v is None, v) for v in r),
    )
    assert {r.file.rsplit("/", 1)[1] for r in rejected.collect()} == {"q.jsonl"}


def test_nested_responses(spark, tmp_path):
    results = [{"question": f"q{i}", "sources": ["u"] if i else [], "answer": "a"} for i in range(3)]
    (tmp_path / "r.json").write_text(json.dumps({"config": {"experiment_name": "e", "chunk_size": 100}, "results": results}, indent=4))
    found = records.scan_responses_json(spark, str(tmp_path / "r.json"), num_samples=2)
    assert rows(found.select("experiment_name", "pos", "question", "sources")) == [("e", 0, "q0", []), ("e", 1, "q1", ["u"])]


def test_nested_records_are_written_in_pieces(spark, tmp_path):
    results = spark.range(25).select(
        F.lit("e").alias("experiment_name"), F.col("id").alias("pos"), F.col("id").cast("string").alias("question"), F.lit("a").alias("answer")
    )
    configs = spark.createDataFrame([("e", 7), ("none", 9)], "experiment_name string, num_chunks int")
    records.write_nested(results, configs, str(tmp_path / "n"), rows_per_record=10)
    records_ = spark.read.json(str(tmp_path / "n"))
    assert rows(records_.where("config is not null").select("experiment_name", "piece", "config.num_chunks")) == [("e", 0, 7), ("none", 0, 9)]
    assert records_.count() == 4
    again = records.scan_responses_json(spark, str(tmp_path / "n"), lines=True)
    assert rows(again.select("pos", "question")) == [(i, str(i)) for i in range(25)]


def test_evaluation_files(spark, tmp_path):
    for name, judge, quality in (("a", "x", 3.5), ("b", "x", None), ("a", "y", 2.0)):
        body = {"config": {"experiment_name": name, "evaluator": judge}, "retrieval_score": 0.5, "results": []}
        if quality is not None:
            body["quality_score"] = quality
        (tmp_path / f"{name}-{judge}.json").write_text(json.dumps(body, indent=4))
    assert rows(records.scan_evaluations_dir(spark, str(tmp_path)), "experiment_name", "evaluator") == [("a", "x", 0.5, 3.5), ("a", "y", 0.5, 2.0), ("b", "x", 0.5, None)]


def test_index_rules(spark, tmp_path):
    good = spark.createDataFrame([(1, "t", "s", [1.0, 2.0]), (2, "t", "s", None)], "id long, text string, source string, embedding array<float>")
    path = str(tmp_path / "ix")
    index_store.write_index(good, path, 2)
    index_store.write_index(good, path, 2)
    assert rows(index_store.read_index_chunks(spark, path)) == [(1, "t", "s"), (2, "t", "s")]
    for bad in (good.withColumn("text", F.lit(None).cast("string")), good.withColumn("embedding", F.array(F.lit(1.0).cast("float")))):
        with pytest.raises(Exception):
            index_store.write_index(bad, str(tmp_path / "bad"), 2)
    index_store.reset_index(spark, path, 2)
    assert index_store.read_index_chunks(spark, path).count() == 0
    scan = index_store.read_index_chunks(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "embedding" not in scan


def test_index_is_built_once(spark, tmp_path, pages):
    built = []

    def build():
        built.append(1)
        return build_index(pages, encoder_factory=HashedWords(8))

    for _ in range(2):
        found = index_store.load_or_build_index(spark, str(tmp_path), "x/model", 8, 700, 50, build)
        assert found.count() == 3
    assert built == [1] and index_store.index_path("r/", "x/model", 700, 50) == "r/model_700_50"


# -- plans -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def index(spark, pages, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ix") / "ix")
    index_store.write_index(build_index(pages, 700, 50, HashedWords(1024)), path, 1024)
    return spark.read.parquet(path).withColumnRenamed("id", "doc_id")


@pytest.fixture(scope="module")
def questions(spark):
    data = [(1, "how to pick the best checkpoint"), (2, "which proxy answer requests"), (3, "are rows shuffled")]
    return spark.createDataFrame(data, "qid long, question string")


def test_retrieve_finds_the_right_page(spark, index, questions):
    tags = spark.createDataFrame([(1, "tune"), (2, "other"), (3, "data")], "qid long, predicted_tag string")
    config = RetrievalConfig(num_chunks=2, lexical_search_k=1, rerank_k=2, tag_prefix="d.example.com/latest/")
    found = retrieve(embed_queries(questions, HashedWords(1024)), index, index, build_lexical_index(index), tags, config)
    top = {r["qid"]: r for r in found.collect()}
    assert [top[q]["texts"][0].split("\n")[0] for q in (1, 2, 3)] == ["tune", "serve", "data"]
    assert all(len(r["document_ids"]) == 2 and r["sources"] == sorted(set(r["sources"])) for r in top.values())


def test_encoders_are_not_mixed(spark, index, questions):
    assert encoder_of(index) == "hashed-words-1024"
    other = embed_queries(questions, HashedWords(1024)).withMetadata("embedding", {"encoder_id": "another"})
    with pytest.raises(ValueError, match="another"):
        retrieve(other, index, index, config=RetrievalConfig(num_chunks=1))


def test_retrieve_predicts_tags(spark, index, questions):
    data = [(t, f"{x} {w}") for t, x in TOPICS.items() for w in ("one", "two", "three", "four")]
    model = classifier.train_tag_classifier(spark.createDataFrame(data, "tag string, text string"), max_iter=20)
    vectors = embed_queries(questions, HashedWords(1024))
    config = RetrievalConfig(num_chunks=3, use_lexical_search=False, rerank_k=1, rerank_threshold=0.3, tag_prefix="d.example.com/latest/")
    found = retrieve(vectors, index, index, config=config, tag_model=model)
    assert [r["texts"][0].split("\n")[0] for r in found.orderBy("qid").collect()] == ["tune", "serve", "data"]


def test_answers_and_experiments(spark, index, questions):
    vectors = embed_queries(questions, HashedWords(1024))
    ranked = retrieve_contexts(vectors, index, index, None, None, RetrievalConfig(num_chunks=3, use_lexical_search=False, use_reranking=False))
    answered = answer_batch(retrieve(vectors, index, index, config=RetrievalConfig(num_chunks=1)), extractive_model, "m", retry_interval=0)
    by_question = {r["qid"]: r for r in answered.collect()}
    assert "best checkpoint" in by_question[1]["answer"] and by_question[1]["llm"] == "m"

    references = spark.createDataFrame(
        [(1, "https://d.example.com/latest/tune/index.html"), (2, "https://d.example.com/latest/serve/index.html#x"), (3, "")],
        "qid long, source string",
    ).join(questions, "qid").withColumn("answer", F.lit("search trials and pick the best checkpoint"))
    configs = [
        {"experiment_name": "none", "num_chunks": 0, "llm": "a"},
        {"experiment_name": "one-a", "num_chunks": 1, "llm": "a"},
        {"experiment_name": "one-b", "num_chunks": 1, "llm": "b"},
    ]
    scores, judged = run_experiments(ranked, questions, references, configs, extractive_model, retry_interval=0)
    by_name = {r["experiment_name"]: r for r in scores.collect()}
    assert judged.count() == 9
    assert by_name["none"]["retrieval_score"] == pytest.approx(1 / 3)  # only the question without a reference page
    assert by_name["one-a"]["retrieval_score"] == by_name["one-b"]["retrieval_score"] == 1.0
    assert by_name["one-a"]["quality_score"] > by_name["none"]["quality_score"]


def test_experiments_over_all_axes(spark, pages, questions):
    sections = extract_sections(pages).select("source", "text")
    references = questions.select("qid", "question", F.lit("").alias("source"), F.lit("trials").alias("answer"))

    def factory():
        return lambda m, llm, max_tokens, temperature: f"{llm}: {m[-1]['content']}"

    configs = [
        {"experiment_name": "base", "llm": "a", "num_chunks": 2},
        {"experiment_name": "llm", "llm": "b", "num_chunks": 1},
        {"experiment_name": "size", "llm": "a", "chunk_size": 40, "chunk_overlap": 0},
        {"experiment_name": "encoder", "llm": "a", "encoder": "wide", "num_chunks": 1},
        {"experiment_name": "lexical", "llm": "a", "num_chunks": 1, "use_lexical_search": True, "lexical_search_k": 1},
    ]
    scores, judged = run_experiment_grid(sections, questions, references, configs, factory, encoders={"wide": HashedWords(512)}, retry_interval=0)
    assert sorted(r["experiment_name"] for r in scores.collect()) == sorted(c["experiment_name"] for c in configs)
    assert judged.count() == 15
    answers = {(r["experiment_name"], r["qid"]): r["generated_answer"] for r in judged.collect()}
    assert answers["llm", 1].startswith("b: ") and answers["base", 1].startswith("a: ")
    assert len(answers["base", 1]) > len(answers["llm", 1]) and len(answers["lexical", 1]) > len(answers["encoder", 1])
    assert answers["size", 1] != answers["base", 1]


def test_given_context_and_judge(spark, pages):
    asked = spark.createDataFrame([("pick the best checkpoint", "https://d.example.com/latest/tune/index.html#tune-top")], "question string, source string")
    answered = answer_with_given_context(asked, pages, retry_interval=0).first()
    assert "best checkpoint" in answered["answer"] and answered["score"] == 4.0

    def broken():
        def call(*_):
            raise RuntimeError("down")

        return call

    references = spark.createDataFrame([(0, "q", "u", "same words")], "pos long, question string, source string, answer string")
    generated = spark.createDataFrame([(0, "q", "same words", ["u"])], "pos long, question string, answer string, sources array<string>")
    assert judge_answers(references, generated, overlap_judge, retry_interval=0).first()["score"] == 5.0
    failed = judge_answers(references, generated, broken, retry_interval=0).first()
    assert failed["call_failed"] and failed["score"] == 0.0


def test_retries(spark):
    def factory():
        calls = []

        def model(m, llm, max_tokens, temperature):
            calls.append(1)
            if m[-1]["content"] == "always" or len(calls) == 1:
                raise ValueError("no")
            return m[-1]["content"].upper()

        return model

    df = spark.createDataFrame([(1, "once"), (2, "fine"), (3, "always")], "n int, t string").coalesce(1)
    asked = df.select("n", messages(F.lit(""), F.lit(""), F.col("t")).alias("messages"))
    found = rows(batch_generate(asked, factory, max_retries=2, retry_interval=0, threads=1))
    assert found == [(1, "ONCE", 2, None), (2, "FINE", 1, None), (3, "", 3, "ValueError: no")]


def test_finished_calls_of_a_killed_task_are_not_made_again(spark, tmp_path):
    told, kept = tmp_path / "told", "file:" + str(tmp_path / "ledger")
    told.mkdir()

    def factory_of(deadly):
        folder = str(told)

        def factory():
            def model(m, llm, max_tokens, temperature):
                import uuid

                text = m[-1]["content"]
                if text == "fails":
                    raise ValueError("no")
                if text == deadly:
                    raise SystemExit("killed")
                open(f"{folder}/{text}-{uuid.uuid4().hex}", "w").close()
                return text.upper()

            return model

        return factory

    texts = [f"t{i}" for i in range(6)] + ["deadly", "t0", "fails", "t7"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").coalesce(1)
    asked = df.select("n", messages(F.lit(""), F.lit(""), F.col("t")).alias("messages"))
    with pytest.raises(Exception):
        batch_generate(asked, factory_of("deadly"), max_retries=0, retry_interval=0, threads=1, ledger=kept).collect()
    before = {p.name.split("-")[0] for p in told.iterdir()}
    assert before == {f"t{i}" for i in range(6)}
    found = rows(batch_generate(asked, factory_of(None), max_retries=0, retry_interval=0, threads=1, ledger=kept))
    assert [r[1] for r in found] == [t.upper() if t != "fails" else "" for t in texts]
    assert [r[2] for r in found] == [0] * 6 + [1, 0, 1, 1] and found[8][3] == "ValueError: no"
    assert sorted(p.name.split("-")[0] for p in told.iterdir()) == sorted([f"t{i}" for i in range(6)] + ["deadly", "t7"])
    assert {r.answer: r.attempts for r in read_ledger(spark, kept).collect()} == {t.upper(): 1 for t in set(texts) - {"fails"}}
    named = rows(batch_generate(asked, factory_of(None), llm=F.lit("other"), max_retries=0, retry_interval=0, threads=2, ledger=kept))
    assert sum(r[2] for r in named) >= 9


def test_no_wait_after_the_last_attempt(spark):
    import time

    def factory():
        def model(m, llm, max_tokens, temperature):
            raise ValueError("no")

        return model

    asked = spark.createDataFrame([(1, "q")], "n int, t string").select("n", messages(F.lit(""), F.lit(""), F.col("t")).alias("messages"))
    started = time.time()
    assert rows(batch_generate(asked, factory, max_retries=0, retry_interval=300)) == [(1, "", 1, "ValueError: no")]
    assert time.time() - started < 100


def test_question_generation(spark):
    chunks = spark.createDataFrame([("s", "Cats sleep. Dogs bark."), ("e", "")], "source string, text string")
    pairs, rejected = generate_qa_per_chunk(chunks, question_writer(2), retry_interval=0)
    assert [r[2:] for r in rows(pairs)] == [("What is said about Cats?", "Cats sleep."), ("What is said about Dogs?", "Dogs bark.")]
    assert rejected.count() == 0


# -- models ------------------------------------------------------------------------


def test_classifier(spark, tmp_path):
    data = [(t, f"{x} {w}") for t, x in TOPICS.items() for w in ("one", "two", "three", "four")]
    model = classifier.train_tag_classifier(spark.createDataFrame(data, "tag string, text string"), max_iter=20)
    classifier.save_model(model, str(tmp_path / "m"))
    model = classifier.load_model(str(tmp_path / "m"))
    asked = spark.createDataFrame([(1, "best trials checkpoint"), (2, "requests behind the proxy")], "qid long, text string")
    assert rows(classifier.predict_tag(model, asked).drop("text")) == [(1, "tune"), (2, "serve")]
    assert {r[2] for r in rows(classifier.predict_tag(model, asked, threshold=1.1))} == {"other"}
    ranked = rows(classifier.predict_proba_ranked(model, asked, "qid"), "qid", "rank")
    assert [r[2] for r in ranked if r[1] == 1] == ["tune", "serve"]
    assert sum(r[3] for r in ranked if r[0] == 1) == pytest.approx(1.0)
    expected = spark.createDataFrame([("best checkpoint", "tune"), ("best checkpoint", "serve")], "question string, tag string")
    assert rows(classifier.minimum_functionality_checks(model, expected)) == [("best checkpoint", "serve", "tune")]


def test_model_runs_once_for_each_text(spark):
    """Filters on the label, and its parts, don't repeat clean-up and model."""
    data = [(t, f"{x} {w}") for t, x in TOPICS.items() for w in ("one", "two", "three", "four")]
    model = classifier.train_tag_classifier(spark.createDataFrame(data, "tag string, text string"), max_iter=5)
    expected = spark.createDataFrame([("best checkpoint", "tune"), ("best checkpoint", "serve")], "question string, tag string")
    failed = classifier.minimum_functionality_checks(model, expected)
    for found in (failed, failed.groupBy("tag").count(), classifier.predict_tag(model, expected, text="question").where("predicted_tag = 'tune'")):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_replace(") == 3, plan
    assert rows(failed) == [("best checkpoint", "serve", "tune")]


def test_router(spark):
    data = [("simple lookup", 1), ("easy lookup", 1), ("hard reasoning numbers", 0), ("complex reasoning", 0)]
    model = classifier.train_router(spark.createDataFrame(data, "question string, target int"), max_iter=20)
    asked = spark.createDataFrame([("a lookup",), ("reasoning",)], "question string")
    assert rows(classifier.route_queries(model, asked, "open", "closed")) == [("a lookup", 1, "open"), ("reasoning", 0, "closed")]


def test_tasks_write_and_read_many_small_files(spark, tmp_path, monkeypatch):
    folder = f"file:{tmp_path}/site"
    pages = spark.range(300).select(F.format_string("p=%1$d/%1$d", "id").alias("name"), F.concat(F.lit("<p>é"), F.col("id")).alias("html"))
    odd = spark.createDataFrame([("twice", "a"), ("twice", "a"), ("empty", None), (None, "x")], "name string, html string")
    assert html_files.write_html_pages(pages.unionByName(odd), folder) == 302
    monkeypatch.setattr(html_files, "SPLITS_TOGETHER", 1 << 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        read = scan_html_pages(spark, folder)
        assert read.rdd.getNumPartitions() == 4 * spark.sparkContext.defaultParallelism
        found = {r["path"].rsplit("/", 1)[1]: r["html"] for r in read.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {f"{i}.html": f"<p>é{i}\n" for i in range(300)} | {"twice.html": "a\na\n", "empty.html": "\n"}


def test_models_keep_their_size_and_learn_from_all_rows(spark):
    few = spark.createDataFrame([("simple lookup", 1), ("hard reasoning", 0)], "question string, target int")
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit("w"), (F.col("id") * 100 + i).cast("string"))))
    many = few.unionByName(spark.range(60).select(words.alias("question"), (F.col("id") % 2).cast("int").alias("target")))
    sizes = [classifier.train_router(df, max_iter=2).stages[-1].coefficientMatrix.numCols for df in (few, many)]
    assert sizes == [classifier.WORD_PLACES] * 2
    tagged = many.select(F.col("target").cast("string").alias("tag"), F.col("question").alias("text"))
    assert classifier.train_tag_classifier(tagged, max_iter=2).stages[-1].coefficientMatrix.numCols == classifier.WORD_PLACES
    # Every word counts: each row is told by words that no other row has.
    model = classifier.train_router(many, max_iter=30)
    found = classifier.route_queries(model, many, "open", "closed")
    assert found.where(F.col("routed") != F.col("target")).count() == 0


# -- streams -----------------------------------------------------------------------


def test_streamed_vectors_are_made_where_chunks_are_written(spark, tmp_path, pages):
    given, inbox = [], str(tmp_path / "in")
    pages.write.parquet(inbox)

    def embed(chunks):
        given.append(chunks._jdf.queryExecution().optimizedPlan().toString())
        return embed_chunks(chunks, HashedWords(8))

    def chunk(batch):
        return chunk_sections(extract_sections(batch).withColumnRenamed("pos", "section_pos"), 40, 0)

    stream = spark.readStream.schema("url string, html string").parquet(inbox)
    jobs.stream_index_pages(stream, chunk, embed, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert given and all(plan.startswith("RepartitionByExpression [bucket") for plan in given)
    assert spark.read.parquet(f"{tmp_path}/out/chunks").where(F.size("embedding") != 8).count() == 0


def test_streamed_pages_supersede_their_older_versions(spark, tmp_path, pages):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")

    def chunk(batch):
        return chunk_sections(extract_sections(batch).withColumnRenamed("pos", "section_pos"), 40, 0)

    def run(checkpoint="cp", source=inbox):
        stream = spark.readStream.schema("url string, html string").parquet(source)
        jobs.stream_index_pages(stream, chunk, lambda c: embed_chunks(c, HashedWords(8)), out, str(tmp_path / checkpoint)).awaitTermination()
        found = jobs.read_streamed_index(spark, out).collect()
        assert len({r["id"] for r in found}) == len(found)
        return {(r["source"], r["section_pos"], r["chunk_pos"]): r["text"] for r in found}

    pages.write.parquet(inbox)
    first = run()
    pages.write.mode("append").parquet(inbox)  # the same pages again
    assert run() == first
    assert spark.read.parquet(f"{out}/chunks").count() == len(first)
    url = "https://d.example.com/latest/tune/index.html"
    shorter = spark.createDataFrame([(url, page("tune", "new"))], "url string, html string")
    shorter.write.mode("append").parquet(inbox)
    edited = run()
    tune = [k for k in first if k[0].startswith(url)]
    assert {k: v for k, v in edited.items() if k not in tune} == {k: v for k, v in first.items() if k not in tune}
    assert len([k for k in edited if k in tune]) < len(tune) and any("new" in v for v in edited.values())
    # A run with a fresh checkpoint knows what is stored: pages that are unchanged are not stored again.
    stored = spark.read.parquet(f"{out}/chunks").count()
    same = str(tmp_path / "in3")
    pages.where(F.col("url") != url).write.parquet(same)
    assert run("cp3", same) == edited and spark.read.parquet(f"{out}/chunks").count() == stored
    # A fresh checkpoint adds to what is there: an unchanged page is left out, a changed one supersedes.
    other = str(tmp_path / "in2")
    pages.where(F.col("url") == url).write.parquet(other)
    assert run("cp2", other) == first
    jobs.compact_streamed_index(spark, out, str(tmp_path / "compact"))
    assert {r["text"] for r in jobs.read_streamed_index(spark, str(tmp_path / "compact")).collect()} == set(first.values())
    assert spark.read.parquet(str(tmp_path / "compact" / "chunks")).count() == len(first)


def test_unpaired_answers_are_not_judged(spark):
    references = spark.createDataFrame([(0, "q", "u", "a"), (1, "r", "u", "b"), (2, "s", "u", "c")], "pos long, question string, source string, answer string")
    generated = spark.createDataFrame([(0, "q", "a", ["u"], "e"), (1, "other", "b", ["u"], "e")], "pos long, question string, answer string, sources array<string>, experiment_name string")
    judged = judge_answers(references, generated, overlap_judge, retry_interval=0)
    assert rows(judged.select("pos", "same_question", "score", "call_failed")) == [(0, True, 5.0, False), (1, False, None, False), (2, False, None, False)]


def test_models_are_told_their_name_and_length(spark):
    def factory():
        return lambda m, llm, max_tokens, temperature: f"{llm} {max_tokens} {temperature}"

    asked = spark.createDataFrame([(1, "q", "gpt-4"), (2, "q", "unknown")], "qid long, question string, llm string")
    retrieved = asked.withColumns({"texts": F.array(F.lit("t")), "sources": F.array(F.lit("s")), "document_ids": F.array(F.lit(1))})
    found = answer_batch(retrieved, factory, F.col("llm"), temperature=0.5, retry_interval=0)
    assert rows(found.select("qid", "answer")) == [(1, "gpt-4 4096 0.5"), (2, "unknown 2048 0.5")]


def test_calls_are_made_once(spark, tmp_path):
    path = str(tmp_path)

    def factory():
        def write(m, llm, max_tokens, temperature):
            import uuid

            open(f"{path}/{uuid.uuid4().hex}", "w").close()
            return "What?\nThis.\n\nlonely"

        return write

    chunks = spark.createDataFrame([(f"s{i}", "text") for i in range(6)], "source string, text string")
    pairs, rejected = generate_qa_per_chunk(chunks, factory, retry_interval=0)
    assert (pairs.count(), rejected.count()) == (6, 6)
    assert len(list(tmp_path.iterdir())) == 6


def test_a_replayed_batch_replaces_itself(spark, tmp_path):
    df = spark.createDataFrame([("q", [1], "m", "a")], "question string, document_ids array<long>, llm string, answer string")
    for _ in range(2):
        jobs.write_batch(records.answer_log_rows(df), str(tmp_path), 7)
    assert spark.read.parquet(str(tmp_path)).count() == 1


def test_answer_stream_and_feedback(spark, tmp_path, questions):
    inbox, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "cp"))
    questions.write.parquet(inbox)
    stream = spark.readStream.schema(questions.schema).parquet(inbox)

    def answer(batch):
        return batch.withColumn("document_ids", F.array("qid")).withColumn("llm", F.lit("m")).withColumn("answer", F.upper("question"))

    jobs.stream_answer_queries(stream, answer, log, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(log).select("query", "llm"))[0] == ("are rows shuffled", "m")

    events = spark.sql("select timestamp'2024-01-01 10:00:00' + make_interval(0,0,0,0,id) ts, 'up' event_type, cast(id as double) value from range(30)")
    assert [r[2] for r in rows(jobs.feedback_rollup(events), "window_start")] == [14, 16]
    events.write.parquet(str(tmp_path / "ev"))
    live = jobs.feedback_rollup(spark.readStream.schema(events.schema).parquet(str(tmp_path / "ev")))
    query = live.writeStream.outputMode("complete").format("memory").queryName("fb").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r["n"] for r in spark.sql("select * from fb").collect()) == [14, 16]
