import math

import pytest
from pyspark.sql import functions as F

from lectern.catalogue import catalogue_join, model_catalogue, prices
from lectern.operators import cost, evaluation, metrics, ranking
from lectern.operators.joins import broadcast_if_small, has_at_most, join_frequent_keys
from lectern.operators.vocabulary import tfidf_weights, word_counts
from tests.conftest import rows


def test_retrieval_score(spark):
    data = [
        ("u#a", ["u#b"]),  # same page
        ("", []),  # no reference: a hit
        (None, []),  # the same
        ("u", ["v", "w"]),
        ("u", []),
        ("u", None),
    ]
    df = spark.createDataFrame(data, "source string, sources array<string>")
    assert rows(evaluation.retrieval_score(df)) == [(0.5, 6)]


def test_alignment(spark):
    left = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos long, question string")
    right = spark.createDataFrame([(0, "a"), (1, "x"), (3, "d")], "pos long, question string")
    assert rows(evaluation.alignment_report(left, right)) == [(3, 3, 2, 1)]
    joined = evaluation.join_refs_generated(left, right.withColumn("answer", F.lit("z")))
    assert rows(joined.select("pos", "same_question")) == [(0, True), (1, False), (2, False), (3, False)]
    assert rows(joined.where("pos = 3").select("question", "answer")) == [("d", "z")]


def test_quality_score(spark):
    data = [(4.0, "r"), (2.0, "r"), (0.0, "r"), (5.0, ""), (None, "r")]
    df = spark.createDataFrame(data, "score double, reference_answer string")
    assert rows(evaluation.quality_score(df)) == [(3.0, 2, 3)]
    assert rows(evaluation.quality_score(df.where("score = 0"))) == [(None, 0, 1)]
    assert evaluation.filter_scored_with_reference(df).count() == 2


def test_mean_reference_score(spark):
    df = spark.createDataFrame([("4",), ("",), ("0",), ("2.0",), ("x",), (None,)], "score string")
    assert rows(evaluation.mean_reference_score(df)) == [(3.0,)]


def test_top_experiments(spark):
    data = [("a", 0.1, 3.0), ("b", 0.9, 3.0), ("c", 0.5, None), ("d", 0.5, 1.0)]
    df = spark.createDataFrame(data, "experiment_name string, retrieval_score double, quality_score double")
    assert [r[0] for r in evaluation.top_experiments(df).collect()] == ["c", "b", "a"]
    assert [r[0] for r in evaluation.experiment_scores(df).collect()] == ["a", "b", "c", "d"]


def test_num_chunks_sweep(spark):
    ranked = spark.createDataFrame([(1, 0, "x#1"), (1, 2, "p#2"), (2, 0, "p"), (3, 0, "x")], "qid long, pos int, source string")
    refs = spark.createDataFrame([(1, "p#z"), (2, "p"), (3, "q"), (4, "")], "qid long, source string")
    assert rows(evaluation.num_chunks_sweep(ranked, refs, [0, 1, 3])) == [(0, 0.25), (1, 0.5), (3, 0.75)]


def test_hit_semi(spark):
    refs = spark.createDataFrame([(1, "p#z"), (2, "q")], "pos long, source string")
    found = spark.createDataFrame([(1, "p#1"), (1, "p#2"), (2, "p")], "pos long, source string")
    assert rows(evaluation.retrieved_hit_semi(refs, found)) == [(1, "p#z")]


def test_prf(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "d")]
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    by_class = {r["label"]: (r["support"], r["precision"], r["recall"], r["f1"]) for r in metrics.class_prf(df).collect()}
    assert by_class["a"] == (4, 1.0, 0.75, pytest.approx(6 / 7))
    assert by_class["b"] == (2, pytest.approx(2 / 3), 1.0, 0.8)
    assert by_class["c"] == (1, 0.0, 0.0, 0.0)
    precision, recall, f1, n = metrics.weighted_prf(df).first()
    assert (precision, recall, n) == (pytest.approx((4 + 4 / 3) / 7), pytest.approx(5 / 7), 7.0)
    assert f1 == pytest.approx((4 * 6 / 7 + 2 * 0.8) / 7)
    assert rows(metrics.confusion_pivot(df, ["a", "b", "d"])) == [("a", 3, 1, 0), ("b", 0, 2, 0), ("c", 0, 0, 1)]


def test_prf_agrees_with_the_library(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    df = spark.range(60).select((F.col("id") % 4).cast("double").alias("label"), (F.col("id") % 7 % 4).cast("double").alias("prediction"))
    ours = metrics.weighted_prf(df, "label", "prediction").first()
    for name in ("Precision", "Recall"):
        theirs = MulticlassClassificationEvaluator(metricName=f"weighted{name}").evaluate(df)
        assert ours[name.lower()] == pytest.approx(theirs)
    assert ours["f1"] == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(df))


def test_routing_summary(spark):
    df = spark.createDataFrame([(1, 4.0), (1, 2.0), (0, 5.0), (1, 3.0)], "predicted int, score double")
    assert rows(metrics.routing_summary(df)) == [(0, 1, 0.25, 5.0), (1, 3, 0.75, 3.0)]


def test_ir_metrics(spark):
    ranked = spark.createDataFrame(
        [(1, p, d) for p, d in enumerate([9, 1, 2])] + [(2, p, d) for p, d in enumerate([5, 6, 7])], "qid long, pos int, doc_id long"
    )
    relevant = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (2, 5), (3, 4)], "qid long, doc_id long")
    got = {r["metric"]: r["value"] for r in metrics.ir_metrics(ranked, relevant).collect()}
    assert got["accuracy@1"] == pytest.approx(1 / 3)
    assert got["accuracy@3"] == pytest.approx(2 / 3)
    assert got["precision@3"] == pytest.approx((2 / 3 + 1 / 3) / 3)
    assert got["recall@3"] == pytest.approx((2 / 3 + 1) / 3)
    assert got["mrr@10"] == pytest.approx((1 / 2 + 1) / 3)
    ideal = 1 + 1 / math.log2(3) + 1 / 2
    assert got["ndcg@10"] == pytest.approx(((1 / math.log2(3) + 1 / 2) / ideal + 1) / 3)
    assert got["map@100"] == pytest.approx(((1 / 2 + 2 / 3) / 3 + 1) / 3)


def test_cost(spark):
    results = spark.createDataFrame(
        [("gpt-4", "q" * 40, "a" * 80), ("gpt-4", "q" * 8, "a" * 4), ("unknown", "q", "a")],
        "experiment_name string, question string, generated_answer string",
    )
    configs = spark.createDataFrame(
        [("gpt-4", 300, 5), ("unknown", 300, 0)], "experiment_name string, chunk_size int, num_chunks int"
    )
    costs = cost.cost_analysis(results, configs, prices(spark))
    found = {r["experiment_name"]: r for r in costs.collect()}
    prompt = 12 + 300 / 5 * 4 / 3 * 5 * 2
    assert found["gpt-4"]["avg_prompt_tokens"] == int(prompt / 2)
    assert found["gpt-4"]["avg_sampled_tokens"] == 10
    assert found["gpt-4"]["total_cost"] == pytest.approx(30 / 1e6 * prompt + 60 / 1e6 * 21)
    assert found["unknown"]["total_cost"] is None
    shares = rows(cost.cost_multiplier(costs, "gpt-4"))
    assert shares == [("gpt-4", 1.0), ("unknown", None)]


def test_catalogue(spark):
    assert model_catalogue(spark).count() == 13
    df = spark.createDataFrame([("gpt-4",), ("x",)], "experiment_name string")
    found = rows(catalogue_join(df).select("experiment_name", "max_context", "sampled_price"))
    assert found == [("gpt-4", 8192, 60.0), ("x", None, None)]


# -- ranks, splits, joins ----------------------------------------------------------


def test_ordinals_with_far_outliers(spark):
    ids = [*range(0, 500, 3), 10**15, -(10**12), 2**53, 2**53 + 1, 2**53 + 2]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(5)
    found = [(r["id"], r["pos"], r["n_rows"]) for r in ranking.with_ordinal(df, "id", buckets=16).collect()]
    assert sorted(found) == [(i, p, len(ids)) for p, i in enumerate(sorted(ids))]


def test_prefix_split_is_a_partition(spark):
    df = spark.range(101).withColumnRenamed("id", "k")
    parts = rows(ranking.split_prefix(df, "k"))
    assert [p for _, p in parts] == ["train"] * 80 + ["validation"] * 21


def test_stratified_split_of_a_hot_label(spark):
    rare = F.when(F.col("id") % 7 > 0, F.concat(F.lit("c"), F.col("id") % 7))  # some labels are missing
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise(rare).alias("tag"))
    split = ranking.split_stratified(df, "tag", "id")
    sizes = {r["tag"]: r["count"] for r in df.groupBy("tag").count().collect()}
    tests = {r["tag"]: r["count"] for r in split.where("part = 'test'").groupBy("tag").count().collect()}
    assert split.count() == 2000
    assert tests == {tag: math.ceil(0.2 * n) for tag, n in sizes.items()}
    again = ranking.split_stratified(df.repartition(7), "tag", "id")
    assert rows(again) == rows(split)


def test_chunk_ids_are_dense_and_stable(spark):
    df = spark.range(300).select(F.lit("same").alias("source"), F.col("id").alias("chunk_pos"))
    first, second = (rows(ranking.assign_chunk_id(d, ["source", "chunk_pos"])) for d in (df, df.repartition(9)))
    assert first == second
    assert sorted(r[-1] for r in first) == list(range(1, 301))


def test_limit_follows_position(spark):
    df = spark.createDataFrame([(3,), (1,), (2,)], "pos int")
    assert rows(ranking.num_samples_limit(df, 2)) == [(1,), (2,)]
    assert ranking.num_samples_limit(df, None).count() == 3


def test_size_checks(spark):
    assert has_at_most(spark.range(5), 5) and not has_at_most(spark.range(6), 5)
    assert "BroadcastHashJoin" in _plan(spark.range(9).join(broadcast_if_small(spark.range(3), 3), "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(spark.range(9).join(broadcast_if_small(spark.range(4), 3), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_join_keeps_every_row(spark, monkeypatch):
    monkeypatch.setattr("lectern.operators.joins.HOT_KEYS", 2)
    big = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 11)).alias("w"), "id")
    keyed = big.groupBy("w").agg(F.count("*").alias("df"))
    assert rows(join_frequent_keys(big, keyed, "w", "df")) == rows(big.join(keyed, "w"))


def test_words_are_counted_where_their_document_is(spark):
    df = spark.createDataFrame([(1, "Aa bb"), (1, "bb"), (None, "cc cc"), (2, None)], "doc_id long, text string")
    counted = word_counts(df, "doc_id", "text")
    assert sorted(map(tuple, counted.collect())) == [("aa", 1, 1), ("bb", 1, 2), ("cc", None, 2)]
    plan = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange ") == 1 and "Exchange hashpartitioning(doc_id" in plan


def test_tfidf(spark):
    df = spark.createDataFrame([(1, "Aa bb aa x"), (2, "bb")], "doc_id long, text string")
    raw = {"aa": 2 * (math.log(3 / 2) + 1), "bb": math.log(3 / 3) + 1}
    norm = math.hypot(*raw.values())
    found = {(r["doc_id"], r["w"]): r["weight"] for r in tfidf_weights(df).collect()}
    assert found == {(1, "aa"): pytest.approx(raw["aa"] / norm), (1, "bb"): pytest.approx(raw["bb"] / norm), (2, "bb"): 1.0}
