import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import quality as q
from lectern.llm import toxicity as toxicity_module
from lectern.llm.toxicity import Shape, fit, held_back, held_out, labelled_sample, score, shares_of, toxicity
from lectern.llm.word_features import LANGUAGES, function_word_table, guessed_languages, letter_words, text_blocks
from tests.conftest import rows

ODD = [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "!!! 123"), (9005, "word " * 60_000), (None, "plain words"), (7, "twice"), (7, "twice")]


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, 0.5, "keep", True) for i, t in pairs], "doc_id long, text string, score double, label string, held_out boolean")


def test_words_of_letters():
    data = "Été Ünd IT'S x×y".encode() + "Ab".encode()
    words = letter_words(np.frombuffer(data, np.uint8), np.array([0, len(data) - 2, len(data)]))
    assert [words.data[a:b].tobytes().decode() for a, b in zip(words.first, words.last)] == ["été", "ünd", "it", "s", "x×y", "ab"]
    assert words.row.tolist() == [0] * 5 + [1]


def test_languages():
    texts = ["the cat of the house", "der hund und die katze", "le chat et les chiens", "el gato y los perros", "", "zzz"]
    (_, _, data, starts), = text_blocks(pa.array(texts))
    assert [LANGUAGES[k] for k in guessed_languages(letter_words(data, starts), function_word_table(20))] == ["en", "de", "fr", "es", "other", "other"]


@pytest.fixture(scope="module")
def small(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet")


def test_toxicity_on_rows_held_out(spark, small):
    docs, labels = small
    english = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("lang = 'en'").select("doc_id").collect()
    english = {r.doc_id for r in english}
    found = {r.doc_id: r for r in toxicity(docs, labels.selectExpr("doc_id", "toxic as label"), shape=Shape(epochs=6)).collect()}
    assert len(found) == 1000
    for held in (False, True):
        own = [(found[r.doc_id].predicted, r.toxic) for r in labels.collect() if found[r.doc_id].held_out == held and r.doc_id in english]
        assert np.mean([a == b for a, b in own]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found.values())


def test_toxicity_of_odd_rows(spark):
    known = docs_of(spark, [(i, "you idiot" if i % 3 == 0 else "a kind word") for i in range(120)] + ODD)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)] + [(None, 1), (5, None)], "doc_id long, label int")
    found = rows(toxicity(known, labels, shape=Shape(epochs=3)).select("doc_id", "held_out", "predicted", "score"))
    assert len(found) == 128 and all(r[3] is not None and 0 <= r[3] <= 1 for r in found)
    told = {r[0]: r[2] for r in found}
    assert all(told[i] == (i % 3 == 0) for i in range(120)) and told[9001] == told[9002] == told[9003] == 0
    assert [r[1] for r in found if r[0] is None] == [None]
    assert toxicity(known.limit(0), labels).count() == 0
    assert rows(toxicity(known, labels.limit(0)).select("predicted").distinct()) == [(0,)]


def test_held_out_rows_are_not_learned(spark):
    known = docs_of(spark, [(i, "red" if i % 2 else "blue") for i in range(60)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, label int")
    other = labels.withColumn("label", held_out("doc_id").cast("int"))
    mixed = labels.where(~held_out("doc_id")).unionByName(other.where(held_out("doc_id")))
    assert rows(toxicity(known, labels)) == rows(toxicity(known, mixed))


def test_all_labelled_rows_teach(spark):
    """Forty words on either side, of which no share has all; the tasks' models are averaged."""
    known = docs_of(spark, [(i, f"it is {'bad' if i % 2 else 'fine'}{chr(97 + i // 2 % 20)}{chr(97 + i // 2 % 40)} as they say") for i in range(1600)] + [(8, "longer than the other one of its id")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(1600)] + [(5000, 1)], "doc_id long, label int")
    shape = Shape(rows=200, epochs=4)
    shares = shares_of(known.select("doc_id", "text"), labels, shape)
    dealt = rows(shares.groupBy("share").count())
    assert len(dealt) == 9 and sum(n for _, n in dealt) == 1600 and shares.where("doc_id = 8 and text like 'longer%'").isEmpty()
    assert "Exchange" not in shares.groupBy("share").applyInArrow(lambda t: t, shares.schema)._jdf.queryExecution().executedPlan().toString()
    found = rows(toxicity(known, labels, shape=shape).where("doc_id <> 8 and held_out").select("doc_id", "predicted"))
    assert len(found) > 250 and np.mean([i % 2 == p for i, p in found]) > 0.97


def test_labelled_texts_travel_once(spark, monkeypatch):
    """Other documents are left out before the shuffle, shares lie in a bucket each, and held-back rows are counted once."""
    known = docs_of(spark, [(i, f"text {i}" if i % 7 else None) for i in range(4000)] + [(None, "plain"), (12, "t")]).select("doc_id", "text")
    labels = spark.createDataFrame([(10 * i, i % 2) for i in range(500)] + [(None, 1), (7, None), (8, 2)], "doc_id int, label int")
    ids = labels.where("doc_id % 10 = 0").select(F.col("doc_id").cast("long"))
    found = toxicity_module.marked(known, ids, 500)
    assert ids.join(known, "doc_id").join(found, "doc_id", "left_anti").isEmpty() and found.count() < 400 + 2 * 3600 / toxicity_module.MARK_BITS
    shape = Shape(rows=45)
    shares = shares_of(known, labels, shape)
    assert rows(shares.select("doc_id", "text", "label")) == [(10 * i, f"text {10 * i}" if i % 7 else "", i % 2) for i in range(400)]
    buckets = shares.select("share").distinct().select(F.pmod(F.hash("share"), F.lit(9)))
    assert shares.select("share").distinct().count() == 9 and buckets.distinct().count() == 9
    counted = []
    monkeypatch.setattr(toxicity_module, "held_back", lambda *given: counted.append(1) or held_back(*given))
    fit(known, labels, Shape(epochs=1, bits=8, steps=1))
    assert counted == [1]


def test_repeats_of_a_score(spark):
    model = fit(docs_of(spark, [(1, "a"), (2, "b")]).select("doc_id", "text"), spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, label int"), Shape(epochs=1, bits=8))
    found = [r.score for r in score(docs_of(spark, ODD), model).where("doc_id = 7").collect()]
    assert len(found) == 2 and found[0] == found[1]


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(0)
    good = rng.random(40_000) < 0.8
    finds, alarms = [0.7, 0.5, 0.6, 0.4], [0.01, 0.03, 0.02, 0.01]
    votes = np.stack([np.where(good, np.where(rng.random(40_000) < a, q.BAD, q.GOOD), np.where(rng.random(40_000) < f, q.BAD, q.GOOD)) for f, a in zip(finds, alarms)], 1)
    votes[rng.random(votes.shape) < 0.1] = q.NOTHING
    patterns, count = np.unique(votes, axis=0, return_counts=True)
    model = q.expectation_maximisation(patterns, count, strength=0.001)
    assert abs(model.good - 0.8) < 0.03
    assert np.allclose(model.says[:, q.BAD, q.BAD], finds, atol=0.06) and np.allclose(model.says[:, q.GOOD, q.BAD], alarms, atol=0.02)


def test_quality_keeps_clean_documents(spark, small):
    docs, labels = small
    found = {r.doc_id: r.keep for r in q.quality(docs).collect()}
    told = [(found[r.doc_id], r.quality) for r in labels.collect()]
    assert np.mean([k for k, good in told if good]) > 0.99 and np.mean([not k for k, good in told if not good]) > 0.95


def test_quality_of_odd_rows(spark, small):
    frame = docs_of(spark, ODD + [(i, f"some plain sentence of the kind that {i} people write in a letter.") for i in range(50)])
    found = q.quality(frame)
    assert found.columns == ["doc_id", "posterior", "score", "keep"] and found.count() == 58
    assert all(r.keep == (r.score >= 0.5) for r in found.collect())
    assert q.quality(frame.limit(0)).count() == 0
    kept = q.scored(frame, q.fit(frame), prefix="")
    assert sorted(kept.columns) == sorted(["doc_id", "text", "label", "held_out", "posterior", "score", "keep"]) and rows(kept.select("label").distinct()) == [("keep",)]


def test_long_texts_keep_no_others_out_of_the_samples(spark):
    """Whatever their hashes, texts larger than the bound leave the sample to the others."""
    small = [(i, "you idiot" if i % 2 else "a kind word") for i in range(60)]
    known = docs_of(spark, small + [(100 + i, "word " * 240_000) for i in range(4)] + [(3, "you idiot, again"), (3, "you idiot")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(100 + i, i % 2) for i in range(4)], "doc_id long, label int")
    found = rows(labelled_sample(known, labels, 4096, 1).select("doc_id", "text", "label"))
    assert found == [(i, t, i % 2) for i, t in small]
    several = rows(labelled_sample(known, labels, 4096, 2).select("doc_id"))
    assert [i for i, in several if i < 100] == list(range(60)) and len(several) == 62
    model = q.fit(known, mb=1)
    assert np.abs(model.weights).sum() > 0
    blank = q.fit(docs_of(spark, [(None, "the cat sat on the mat and it was good for all of us"), (None, "!!!! $$$$ ####")]))
    assert np.abs(blank.weights).sum() > 0
