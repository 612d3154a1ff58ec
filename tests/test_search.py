import math
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.operators import batches, block_topk, lexical, postings, vector_index
from lectern.operators.embedding import HashedWords, embed, embed_chunks, mean_vectors
from lectern.operators.hybrid import attach_documents, hybrid_merge
from lectern.operators.rerank import rerank_by_tag, rerank_truncate
from lectern.operators.semantic import distance_summary, semantic_topk
from tests.conftest import rows


def brute_bm25(docs, query):
    """Scores of all documents for one query, by the definition."""
    n, total = len(docs), sum(map(len, docs))
    df = {}
    for doc in docs:
        for w in set(doc):
            df[w] = df.get(w, 0) + 1
    raw = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    mean = sum(raw.values()) / len(raw)
    idf = {w: (0.25 * mean if r < 0 else r) for w, r in raw.items()}
    scores = []
    for doc in docs:
        s = 0.0
        for w in query:
            tf = doc.count(w)
            s += idf.get(w, 0) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(doc) / (total / n)))
        scores.append(s)
    return scores


def best(scores, k):
    return sorted(range(len(scores)), key=lambda i: (-round(scores[i], 9), i))[:k]


def corpus(spark, docs, parts=3):
    return spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string").repartition(parts)


def asked(spark, queries):
    return spark.createDataFrame([(i, " ".join(q)) for i, q in enumerate(queries)], "qid long, question string")


def random_texts(n, seed, words=12, longest=15):
    r = random.Random(seed)
    return [[f"w{min(r.randrange(words), r.randrange(words))}" for _ in range(r.randrange(longest))] for _ in range(n)]


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(postings, "SHARD_DOCS", 3)
    monkeypatch.setattr(postings, "SHARDS_TOGETHER", 4)


@pytest.mark.parametrize("ways", [{}, {"names": 0}])
def test_lexical_topk_against_brute_force(spark, small_shards, ways):
    docs = random_texts(40, 1)
    queries = [*random_texts(7, 2), ["w1", "w1", "w2"], ["unknown"], []]
    index = lexical.build_lexical_index(corpus(spark, docs))
    found = rows(lexical.lexical_topk(index, asked(spark, queries), 6, **ways), "qid", "pos")
    wanted = [(q, pos, i) for q, words in enumerate(queries) for pos, i in enumerate(best(brute_bm25(docs, words), 6))]
    assert [(r[0], r[1], r[2]) for r in found] == wanted
    for qid, _, doc, score in found:
        assert score == pytest.approx(brute_bm25(docs, queries[qid])[doc], abs=1e-8)


def test_negative_mean_idf_lets_unmatched_documents_win(spark):
    docs = [["a", "b"], ["a", "b"], ["a", "b"], ["c"]]
    index = lexical.build_lexical_index(corpus(spark, docs))
    found = rows(lexical.lexical_topk(index, asked(spark, [["a"]]), 4), "pos")
    assert [r[2] for r in found] == best(brute_bm25(docs, ["a"]), 4)
    assert found[0][2] == 3 and found[0][3] == 0


def test_k_zero_and_k_beyond_the_corpus(spark):
    docs = random_texts(4, 3)
    index = lexical.build_lexical_index(corpus(spark, docs))
    assert lexical.lexical_topk(index, asked(spark, [["w1"]]), 0).count() == 0
    assert lexical.lexical_topk(index, asked(spark, [["w1"]]), 9).count() == 4


def test_bm25_score_summary(spark):
    docs, queries = random_texts(30, 4), random_texts(5, 5)
    index = lexical.build_lexical_index(corpus(spark, docs))
    for ways in ({}, {"names": 0}):
        for qid, matched, total, top in rows(lexical.bm25_score(index, asked(spark, queries), **ways)):
            scores = brute_bm25(docs, queries[qid])
            assert matched == sum(s != 0 for s in scores)
            assert (total, top) == (pytest.approx(sum(scores)), pytest.approx(max(scores)))


def test_blocks_are_skipped_without_loss(spark, small_shards):
    """Rare words decide: shards without them are not read, and the best are those of a full scan."""
    r = random.Random(12)
    docs = [[f"c{r.randrange(4)}" for _ in range(r.randrange(1, 9))] + (["rare"] * r.randrange(1, 4) if i % 17 == 0 else []) for i in range(400)]
    queries = [["rare", "c1"], ["c0", "c2"], ["rare"], ["none"]]
    index = lexical.build_lexical_index(corpus(spark, docs))
    found = rows(lexical.lexical_topk(index, asked(spark, queries), 5), "qid", "pos")
    assert [(r[0], r[2]) for r in found] == [(q, i) for q, words in enumerate(queries) for i in best(brute_bm25(docs, words), 5)]
    told = {r.qid: r for r in lexical.skipped_blocks(index, asked(spark, queries), 5).collect()}
    assert set(told) == {0, 1, 2} and told[0].n_read < 0.3 * told[0].n_shards
    assert all(0 < t.n_read <= t.n_shards for t in told.values())


@pytest.mark.parametrize("seed", range(3))
def test_words_of_negative_weight(spark, small_shards, seed):
    """Most words stand in most documents, so that idf and scores fall below 0."""
    r = random.Random(seed)
    docs = [[w for w in "abc" if r.random() < 0.9] + (["d"] if r.random() < 0.1 else []) for _ in range(60)]
    queries = [["a"], ["a", "b", "d"], ["c", "d"], ["d"], []]
    index = lexical.build_lexical_index(corpus(spark, docs))
    for k in (3, 30, 70):
        found = rows(lexical.lexical_topk(index, asked(spark, queries), k), "qid", "pos")
        assert [(r[0], r[2]) for r in found] == [(q, i) for q, words in enumerate(queries) for i in best(brute_bm25(docs, words), k)]


def test_postings_side_is_not_shuffled(spark):
    docs = random_texts(200, 10, words=60)
    index = lexical.build_lexical_index(corpus(spark, docs))
    terms = lexical.tokenize_queries(asked(spark, [["w1", "w2"]]))
    named = lexical.postings_join(index, terms)._jdf.queryExecution()
    assert "Exchange hashpartitioning" not in named.executedPlan().toString()
    scan = named.sparkPlan().collectLeaves().apply(0)
    assert scan.optionalBucketSet().get().cardinality() <= 2
    joined = postings.of_words(index.postings.select("w", "doc_ids"), index.terms.select("w"), names=0, most=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin") :].split("Exchange")[0]
    assert "Bucketed: true" in side and "FileScan" in side


def test_rows_without_ids_and_empty_corpora(spark):
    df = spark.createDataFrame([(1, "a b"), (None, "a a"), (2, None), (3, "")], "doc_id long, text string")
    index = lexical.build_lexical_index(df)
    assert [r[2] for r in rows(lexical.lexical_topk(index, asked(spark, [["a"]]), 9), "pos")] == [1, 2, 3]
    empty = lexical.build_lexical_index(df.limit(0))
    assert lexical.lexical_topk(empty, asked(spark, [["a"]]), 2).count() == 0


def test_tokens_of_the_index_are_those_of_the_expression(spark):
    texts = [None, "", "  ", "A b-C  d_e", "\u0130x \u212ay 12", "é1ü 日本a", "Zz\n\tQ", "ab", "cd"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    want = [list(r.tokens) for r in lexical.tokenize_corpus(df).orderBy("doc_id").collect()]
    words, row = postings.batch_tokens(pa.array(texts))
    told = [[] for _ in texts]
    for w, r in zip(words.to_pylist(), row.tolist()):
        told[r].append(w)
    assert told == want
    assert len(postings.batch_tokens(pa.array(["", None], pa.string()))[0]) == 0


def test_peaks_have_the_largest_saturation():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 60))
        block = np.sort(rng.integers(0, 5, n))
        block = np.unique(block, return_inverse=True)[1]
        tf, dl = rng.integers(1, 6, n), rng.integers(1, 40, n)
        peak = postings.peaks_of(block, tf, dl)
        for avgdl, k1, b in ((10.0, 1.5, 0.75), (3.0, 0.2, 1.0), (50.0, 2.0, 0.0)):
            sat = postings.saturation(tf.astype(float), dl, k1, b, avgdl)
            for i in np.unique(block):
                assert sat[(block == i) & peak].max() == pytest.approx(sat[block == i].max())


def test_stored_lexical_index(spark, tmp_path):
    docs, queries = random_texts(20, 6), random_texts(4, 7)
    index = lexical.build_lexical_index(corpus(spark, docs))
    lexical.write_lexical_index(index, str(tmp_path / "ix"))
    again = lexical.read_lexical_index(spark, str(tmp_path / "ix"))
    assert rows(lexical.lexical_topk(again, asked(spark, queries), 3)) == rows(lexical.lexical_topk(index, asked(spark, queries), 3))
    with pytest.raises(FileNotFoundError):
        lexical.read_lexical_index(spark, str(tmp_path / "none"))


def test_postings_of_question_words(spark):
    docs = [["a", "a", "b"], ["b"], ["c"]]
    index = lexical.build_lexical_index(corpus(spark, docs))
    terms = lexical.tokenize_queries(asked(spark, [["a", "zz"], ["b"]]))
    found = rows(lexical.postings_join(index, terms).select("w", "doc_id", "tf"))
    assert found == [("a", 0, 2), ("b", 0, 1), ("b", 1, 1)]


def test_partitioning_does_not_matter(spark):
    docs, queries = random_texts(50, 8), random_texts(6, 9)
    results = []
    for parts in (1, 4, 16):
        index = lexical.build_lexical_index(corpus(spark, docs, parts))
        results.append(rows(lexical.lexical_topk(index, asked(spark, queries), 5)))
    assert results[0] == results[1] == results[2]


# -- semantic ----------------------------------------------------------------------


def vectors(spark, matrix, name, parts=3):
    data = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(data, f"{name} long, embedding array<float>").repartition(parts)


def brute_cosine(v, q):
    return 1 - float(np.dot(v, q) / (np.linalg.norm(v) * np.linalg.norm(q)))


@pytest.mark.parametrize("ways", [{}, {"max_queries": 2}])
def test_semantic_topk_against_brute_force(spark, ways):
    r = np.random.default_rng(0)
    corpus_vectors = r.normal(size=(30, 8)).astype(np.float32)
    corpus_vectors[7] = corpus_vectors[3]
    queries = r.normal(size=(5, 8)).astype(np.float32)
    found = rows(semantic_topk(vectors(spark, corpus_vectors, "doc_id"), vectors(spark, queries, "qid"), 4, **ways), "qid", "pos")
    for qid in range(5):
        distances = [brute_cosine(v.astype(float), queries[qid].astype(float)) for v in corpus_vectors]
        wanted = sorted(range(30), key=lambda i: (round(distances[i], 9), i))[:4]
        assert [row[2] for row in found if row[0] == qid] == wanted
        assert [row[3] for row in found if row[0] == qid] == [pytest.approx(distances[i], abs=1e-8) for i in wanted]


def test_zero_and_missing_vectors_come_last(spark):
    index = vectors(spark, [None, [0, 0], [1, 0], [0, 1], [-1, 0]], "doc_id")
    found = rows(semantic_topk(index, vectors(spark, [[1, 0]], "qid"), 5), "pos")
    assert [(r[2], r[3]) for r in found] == [(2, 0.0), (3, 1.0), (4, 2.0), (1, None), (0, None)]
    assert rows(distance_summary(index, vectors(spark, [[1, 0]], "qid"))) == [(0, 3, 1.0, 0.0, 2.0)]


@pytest.mark.parametrize("block", [2048, 3])
def test_cluster_index_gives_the_rows_of_a_scan(spark, monkeypatch, block):
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 6))
    corpus_vectors = [list(centres[i % 12] + 0.05 * r.normal(size=6)) for i in range(300)]
    corpus_vectors += [corpus_vectors[7]] * 120 + [None, [0.0] * 6, None]
    queries = [list(centres[3]), list(r.normal(size=6)), corpus_vectors[7], [0.0] * 6, list(-centres[5])]
    index, asks = vectors(spark, corpus_vectors, "doc_id"), vectors(spark, queries, "qid")
    monkeypatch.setattr(vector_index, "query_blocks", lambda q: block_topk.query_blocks(q, block))
    stored = vector_index.build_vector_index(index)
    for k in (1, 5, 130, 500):
        report = []
        found = rows(vector_index.semantic_search(stored, asks, k, report).select("qid", "pos", "doc_id"))
        assert found == rows(semantic_topk(index, asks, k).select("qid", "pos", "doc_id"))
        if k == 5:
            assert sum(reads for _, _, reads in report) < 0.7 * sum(n * c for n, c, _ in report)
    assert vector_index.semantic_search(stored, asks, 0).count() == 0


def test_cluster_index_edges(spark, tmp_path):
    odd = vectors(spark, [None, [0, 0]], "doc_id")
    query = vectors(spark, [[1, 1]], "qid")
    stored = vector_index.build_vector_index(odd)
    assert [r[2] for r in rows(vector_index.semantic_search(stored, query, 5), "pos")] == [1, 0]
    assert vector_index.semantic_search(vector_index.build_vector_index(odd.limit(0)), query, 5).count() == 0
    made = embed_chunks(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), HashedWords(8))
    again = vector_index.build_vector_index(made, str(tmp_path / "v"))
    with pytest.raises(ValueError, match="cannot be compared"):
        vector_index.semantic_search(again, embed(spark.createDataFrame([(1, "a")], "qid long, question string"), HashedWords(4), "question"), 1)
    with pytest.raises(FileNotFoundError):
        vector_index.read_vector_index(spark, str(tmp_path / "none"))


def test_semantic_edges(spark):
    index, query = vectors(spark, [[1, 0], [0, 1]], "doc_id"), vectors(spark, [[1, 1]], "qid")
    assert semantic_topk(index, query, 0).count() == 0
    assert [r[2] for r in rows(semantic_topk(index, query, 5), "pos")] == [0, 1]
    with pytest.raises(Exception, match="dimensions"):
        semantic_topk(index, vectors(spark, [[1, 1, 1]], "qid"), 1).collect()


def test_encoder(spark):
    encoder = HashedWords(16)
    df = spark.createDataFrame([(1, "Foo foo bar"), (2, ""), (3, None), (4, "¿?")], "n int, text string")
    found = {r["n"]: r["embedding"] for r in embed_chunks(df, encoder).collect()}
    wanted = np.zeros(16)
    wanted[encoder.bucket("foo")] += 2
    wanted[encoder.bucket("bar")] += 1
    assert found[1] == pytest.approx(list(wanted / np.linalg.norm(wanted)), abs=1e-6)
    assert all(sum(found[n]) == 0 and len(found[n]) == 16 for n in (2, 3, 4))


def test_an_encoder_gets_long_texts_a_few_at_a_time(spark):
    """However many rows it takes, as splitting texts into words takes many times their memory."""

    def factory():
        def encode(texts):
            assert texts.nbytes <= 1 << 20
            return np.array([[len(t)] for t in texts.to_pylist()], float)

        return encode

    texts = spark.range(0, 250, 1, 1).selectExpr("id as n", "repeat('ab ', cast(6000 + id as int)) as text")
    assert [(r["n"], list(r["embedding"])) for r in embed_chunks(texts, factory).orderBy("n").collect()] == [(i, [3.0 * (6000 + i)]) for i in range(250)]


def test_large_batches_are_worked_on_in_pieces():
    texts = ["a" * 3_000_000, None, *["b c" * 1000] * 5000]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "shard": pa.array([0] * len(texts), pa.int32()), "text": pa.array(texts)})
    cut = list(batches.pieces(batch))
    assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))
    assert max(p.nbytes for p in cut) <= batches.PIECE_BYTES and not list(batches.pieces(batch.slice(0, 0)))
    seen = [sum(b["dls"].flatten().to_pylist()) for b in postings.invert(iter([batch])) if len(b)]
    assert len(seen) > 1, "segments of one batch come piece by piece"
    found = pa.Table.from_batches(list(postings.invert(iter([batch]))))
    assert sorted(x for d in found["doc_ids"].to_pylist() for x in d).count(0) == 1
    encoded = HashedWords(256)
    assert encoded.batch_rows * 256 <= 256_000


def test_a_frequent_word_is_merged_for_some_shards_at_a_time(monkeypatch):
    """What is put in order at once does not follow the number of a word's documents; blocks stay whole."""
    monkeypatch.setattr(postings, "MERGED", 100)
    docs = pa.record_batch(
        {"doc_id": pa.array(range(1000), pa.int64()), "shard": pa.array([i * 7 % 20 for i in range(1000)], pa.int32()),
         "text": pa.array([f"the {'word ' * (i % 3)} {'often' if i % 2 else i}" for i in range(1000)])}
    )
    segments = pa.Table.from_batches([b for lo in range(0, 1000, 90) for b in postings.invert(iter([docs.slice(lo, 90)]))]).sort_by([("w", "ascending"), ("span", "ascending")])
    made = list(postings.merge_segments(iter(segments.to_batches(max_chunksize=50))))
    assert max(len(b["doc_ids"].flatten()) for b in made) <= 100
    table = pa.Table.from_batches(made)
    found = {(r["w"], r["shard"]): r for r in table.to_pylist()}
    assert len(found) == table.num_rows
    wanted = {}
    for i, (shard, text) in enumerate(zip(docs["shard"].to_pylist(), docs["text"].to_pylist())):
        for w in set(text.split()):
            wanted.setdefault((w, shard), []).append((i, text.split().count(w), len(text.split())))
    assert {k: list(zip(r["doc_ids"], r["tfs"], r["dls"])) for k, r in found.items()} == wanted
    assert all(r["n"] == len(r["doc_ids"]) and r["n_tokens"] == sum(r["tfs"]) for r in found.values())


def test_blocks_of_many_shards_are_scored_shard_by_shard(monkeypatch):
    asked = [[{"qid": 1, "weight": 2.0}]] * 40
    rows_of = pa.record_batch(
        {"shard": pa.array(range(40), pa.int32()), "doc_ids": pa.array([[i] for i in range(40)], pa.list_(pa.int64())),
         "tfs": pa.array([[1]] * 40, pa.list_(pa.int32())), "dls": pa.array([[3]] * 40, pa.list_(pa.int32())),
         "asks": pa.array(asked, pa.list_(pa.struct([("qid", pa.int64()), ("weight", pa.float64())])))}
    )
    whole = [hit for table in postings.whole_runs(iter([rows_of]), "shard") for hit in postings.hits_of(table, 1.5, 0.75, 3.0)]
    parts = list(batches.pieces(rows_of, 200))
    assert len(parts) > 4
    cut = [hit for table in postings.whole_runs(iter(parts), "shard") for hit in postings.hits_of(table, 1.5, 0.75, 3.0)]
    for i in range(3):
        assert np.concatenate([h[i] for h in cut]).tolist() == np.concatenate([h[i] for h in whole]).tolist()


def test_a_shard_with_many_hits_is_scored_for_some_questions_at_a_time(monkeypatch):
    r = random.Random(5)
    n, words = 40, []
    for shard in (0, 1):
        for _ in range(6):
            docs = sorted(r.sample(range(n), 25))
            asks = [{"qid": q, "weight": r.random()} for q in r.sample(range(30), 20)]
            words.append((shard, [shard * n + d for d in docs], [r.randrange(1, 5) for _ in docs], [r.randrange(5, 9) for _ in docs], asks))
    kinds = (pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.struct([("qid", pa.int64()), ("weight", pa.float64())])))
    table = pa.table({c: pa.array([w[i] for w in words], k) for i, (c, k) in enumerate(zip(("shard", "doc_ids", "tfs", "dls", "asks"), kinds))})
    wanted = {}
    for _, docs, tfs, dls, asks in words:
        for ask in asks:
            for d, tf, dl in zip(docs, tfs, dls):
                wanted[ask["qid"], d] = wanted.get((ask["qid"], d), 0.0) + ask["weight"] * postings.saturation(float(tf), dl, 1.5, 0.75, 6.0)
    monkeypatch.setattr(postings, "HITS", 300)
    found = list(postings.hits_of(table, 1.5, 0.75, 6.0))
    assert max(len(q) for q, _, _ in found) <= 300 + n, "one more question at most"
    assert {(int(q), int(d)): s for hit in found for q, d, s in zip(*hit)} == wanted and sum(len(h[0]) for h in found) == len(wanted)
    assert all((np.diff(q) >= 0).all() for q, _, _ in found)


def test_vectors_are_scored_in_pieces(spark):
    vectors = spark.range(6000).selectExpr("id as doc_id", "transform(sequence(1, 256), x -> cast(sin(x * id) as float)) as embedding").coalesce(1)
    asked_for = vectors.where("doc_id in (7, 11)").withColumnRenamed("doc_id", "qid").toArrow()

    def reduce(held, scorer, qids):
        seen = list(held)
        return pa.record_batch({"most": pa.array([max(b.nbytes for b in seen)]), "n": pa.array([sum(b.num_rows for b in seen)])})

    told = block_topk.scan_corpus(vectors, asked_for, lambda table: None, reduce, "most long, n long").first()
    assert told.most <= batches.PIECE_BYTES and told.n == 6000


def test_workers_load_no_more_than_they_use():
    code = "import sys, lectern.operators.embedding, lectern.operators.postings, lectern.operators.semantic, lectern.functions.html; print('pandas' in sys.modules)"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True, cwd=Path(batches.__file__).parents[2]).stdout.strip() == "False"


def test_own_encoder_is_made_once_per_task_and_fed_in_batches(spark):
    def factory():
        seen = []

        def encode(texts):
            seen.append(len(texts))
            return np.array([[len(seen), len(texts)]] * len(texts))

        return encode

    df = spark.range(250, numPartitions=1).withColumn("text", F.lit("x"))
    sizes = embed(df, factory).select("embedding").distinct().collect()
    assert sorted(tuple(r[0]) for r in sizes) == [(1.0, 100.0), (2.0, 100.0), (3.0, 50.0)]


def test_mean_vectors(spark):
    df = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [2.0, 2.0])], "k string, embedding array<float>")
    assert rows(mean_vectors(df, "k")) == [("a", [0.5, 0.5]), ("b", [2.0, 2.0])]


# -- merge and rerank --------------------------------------------------------------


@pytest.mark.parametrize("k", [0, 1, 2, 5])
def test_merge_is_a_list_insert(spark, k):
    semantic, lexicals = [10, 11, 12], [20, 11]
    wanted = list(semantic)
    wanted[k:k] = lexicals
    s = spark.createDataFrame([(1, i, d) for i, d in enumerate(semantic)], "qid long, pos int, doc_id long")
    x = spark.createDataFrame([(1, i, d) for i, d in enumerate(lexicals)], "qid long, pos int, doc_id long")
    merged = rows(hybrid_merge(s, x, k), "pos")
    assert [r[1] for r in merged] == list(range(5))
    assert [r[2] for r in merged] == wanted


def contexts(spark):
    data = [(1, 0, 5, "a"), (1, 1, 6, "b"), (1, 2, 7, None), (1, 3, 8, "b"), (2, 0, 5, "a"), (2, 1, 6, "b")]
    return spark.createDataFrame(data, "qid long, pos int, doc_id long, tag string")


def predicted(spark, *tags):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(tags)], "qid long, predicted_tag string")


def test_rerank_is_stable(spark):
    found = rows(rerank_by_tag(contexts(spark), predicted(spark, "b", "other")), "qid", "pos")
    assert [r[2] for r in found] == [6, 8, 5, 7, 5, 6]
    none = rows(rerank_by_tag(contexts(spark), predicted(spark, "zzz")), "qid", "pos")
    assert [r[2] for r in none] == [5, 6, 7, 8, 5, 6]


def test_truncate(spark):
    assert rerank_truncate(contexts(spark), 1).count() == 2
    assert rerank_truncate(contexts(spark), 9).count() == 6


def test_attach_documents_both_ways(spark):
    docs = spark.createDataFrame([(5, "five"), (6, "six"), (9, "nine")], "doc_id long, text string")
    results = spark.createDataFrame([(1, 0, 5), (1, 1, 6), (2, 0, 5)], "qid long, pos int, doc_id long")
    wanted = [(5, "five", 1, 0), (5, "five", 2, 0), (6, "six", 1, 1)]
    assert rows(attach_documents(results, docs)) == rows(attach_documents(results, docs, max_rows=1)) == wanted
