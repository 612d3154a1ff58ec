import hashlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import suffix_arrays
from lectern.llm.decontamination import leaks, without_leaks
from lectern.llm.exact_topk import exact_topk
from lectern.llm.suffix_arrays import common_prefixes, drop_repeated_strings, string_owners, suffix_array
from lectern.llm.url_rules import judge_urls, mined_rules
from tests.conftest import rows


def topk_by_hand(vectors, asked, k):
    whole = {i: np.floor(256 * np.array(v, float)).astype(int).tolist() for i, v in vectors if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted({i for i in asked if i in whole}):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("block", [16_384, 3])
def test_exact_topk(spark, block):
    rng = np.random.default_rng(4)
    vectors = [(i, (np.round(rng.normal(0, 1, 8), 1) * (1 if i % 9 else 5)).tolist()) for i in range(150)]
    vectors += [(200, None), (201, [0.1, None]), (202, [float("nan")] * 8), (203, [float("inf")] * 8), (204, [1.0]), (205, []), (206, [0.0] * 8), (7, vectors[7][1]), (None, [1.0] * 8)]
    vectors += [(300 + i, vectors[i][1]) for i in range(20)]
    frame = spark.createDataFrame([(i, v, 5, "x") for i, v in vectors], "vec_id long, embedding array<double>, rank int, score string").repartition(4)
    found = exact_topk(frame, frame.where("vec_id % 7 = 0"), k=5, query_block=block)
    assert rows(found) == topk_by_hand(vectors, [i for i, _ in vectors if i is not None and i % 7 == 0], 5)
    assert exact_topk(frame.limit(0), frame, k=5).count() == 0 and exact_topk(frame, frame.limit(0), k=5).count() == 0
    assert exact_topk(frame.where("vec_id < 3"), frame.where("vec_id = 0"), k=5).count() == 2


def test_scores_beyond_doubles_are_exact(spark):
    """Sums of some 2^55, where doubles are eight apart."""
    rng = np.random.default_rng(8)
    data = [(i, [float(x) for x in 100_000 + rng.integers(0, 3, 64) / 256]) for i in range(40)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    whole = {i: [int(256 * x) for x in v] for i, v in data}
    found = rows(exact_topk(frame, frame.where("vec_id % 7 = 0"), k=5).select("query_id", "rank", "vec_id", "score"))
    want = []
    for q in range(0, 40, 7):
        scores = sorted((-sum(x * y for x, y in zip(whole[q], whole[i])), i) for i in whole if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
    assert found == want


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
URLS = [
    ("http://A.Example.ORG/es/x?q", "a.example.org", "/es/x", "example.org/es/", "block"),
    ("x://example.org/en/12#a", "example.org", "/en/12", "example.org/en/1", "block"),
    ("x://example.org/En/12", "example.org", "/En/12", "org/", "allow"),
    ("x://badexample.org/es/", "badexample.org", "/es/", "org/", "allow"),
    ("x://example.org", "example.org", "", None, "allow"),
    ("x://a.com/fr/\nb", "a.com", "/fr/\nb", "com/fr/", "allow"),
    ("x://a.com/fr?/de/", "a.com", "/fr", None, "allow"),
    ("y://com/de/://z.org/", "com", "/de/://z.org/", "com/de/", "block"),
    ("no scheme.org/es/", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("x://ÄB.org:80/a b", "Äb.org:80", "/a b", None, "allow"),
    ("x://" + "a/" * 30_000, "a", "/" + "a/" * 29_999, None, "allow"),
]


def test_given_rules(spark):
    pages = spark.createDataFrame([(i, u[0], "h", "r", 1) for i, u in enumerate(URLS)] + [(None, URLS[0][0], "h", "r", 1)], "page_id long, url string, host string, rule string, verdict int")
    labels = spark.createDataFrame([], "page_id long, bad boolean")
    found = judge_urls(pages, labels, RULES).collect()
    assert {r.page_id: tuple(r[1:]) for r in found} == {**{i: u[1:] for i, u in enumerate(URLS)}, None: URLS[0][1:]}
    assert judge_urls(pages.limit(0), labels, RULES).count() == 0


def test_mined_rules_are_all_frequent_and_confident_ones(spark):
    rng = np.random.default_rng(8)
    baskets = [sorted({f"t{k}" for k in rng.integers(0, 6, 4)}) for _ in range(200)]
    bad = ["t1" in b and "t3" in b or rng.random() < 0.1 for b in baskets]
    pages = spark.createDataFrame([(i, b) for i, b in enumerate(baskets)] + [(None, ["t1"])], "page_id long, tokens array<string>")
    labels = spark.createDataFrame([(i, bool(b)) for i, b in enumerate(bad)] + [(None, True), (1, None)], "page_id long, bad boolean")
    want = {}
    for n in range(1, 7):
        for items in combinations([f"t{k}" for k in range(6)], n):
            own = [b for basket, b in zip(baskets, bad) if set(items) <= set(basket)]
            if sum(own) >= 20 and sum(own) >= 0.6 * len(own) and sum(own) * 200 > sum(bad) * len(own):
                want[items] = (round(sum(own) / len(own), 9), round(sum(own) / 200, 9))
    found = mined_rules(pages, labels, min_support=0.001, min_count=20, min_confidence=0.6).collect()
    assert {tuple(r.tokens): (round(r.confidence, 9), round(r.support, 9)) for r in found} == want and want


def test_mined_rules_block(spark):
    urls = [f"http://{'spam' if i % 2 else 'good'}.net/p/{i}" for i in range(100)]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(500, "http://spam.net/q/new")], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 1) for i in range(80)], "page_id long, bad boolean")
    found = judge_urls(pages, labels, RULES).select("verdict", F.col("host").contains("spam").alias("s")).distinct().collect()
    assert {tuple(r) for r in found} == {("block", True), ("allow", False)}


def test_rules_of_any_part_of_a_url(spark):
    def urls(i):
        yield f"http://h{i}.net/{i}/x/{i % 7}/buy-cheap-pills-{i}", True
        yield f"http://h{i}.net/{i}/x/{i % 7}/buy-fresh-bread-{i}", False
        yield f"http://h{i}.net/{i}/x/{i % 7}/buy-plain-bread-{i}", False
        yield f"http://g{i}.net/a/?id={i}&spam={i}&z{i}=1", True
        yield f"http://g{i}.net/a/?id={i}&tone=loud{i}&mode=sell&z{i}=1", True
        for n in range(4):
            yield f"http://g{i}.net/a/?id={i}&n{n}=1&mode=read&z{i}=1", False
            yield f"http://k{i}.net/{i}/{i}/red-{n}-door", False
            yield f"http://k{i}.net/{i}/{i}/blue-{n}-gate", False
        yield f"http://k{i}.net/{i}/{i}/red-{i}-gate", True

    taught = [u for i in range(30) for u in urls(i)]
    new = [u for i in range(1000, 1003) for u in urls(i)]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(taught + new)], "page_id long, url string")
    labels = spark.createDataFrame([(k, b) for k, (_, b) in enumerate(taught)], "page_id long, bad boolean")
    verdict = {r.page_id: r.verdict for r in judge_urls(pages, labels, RULES).collect()}
    assert [verdict[k] == "block" for k in range(len(taught + new))] == [b for _, b in taught + new]


QUESTION = "If Maria buys 12 apples for 3 dollars each at the market near 5 old stations, how much money does Maria spend in total on 12 apples?"
OTHER = QUESTION.replace("Maria", "Pavel").replace("12", "47").replace("3 dollars", "9 euros").replace("5", "8")


def leak_docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "n", "k") for i, t in texts], "doc_id long, text string, item_id int, n_windows string, k1 string")


def items_of(spark, texts):
    return spark.createDataFrame([(i, t, "hash") for i, t in texts], "item_id long, text string, hash string")


def test_template_leaks(spark):
    clean = "The market near the old station sells apples and pears, and nobody there asks how much money a visitor spends in total on them."
    mixed = OTHER.replace("does Pavel", "does Olga")
    docs = [(1, "Before. " + QUESTION + " After."), (2, "x\n" + OTHER), (3, clean), (4, mixed), (5, None), (6, ""), (7, QUESTION.upper()), (8, clean * 500), (1, "Before. " + QUESTION + " After."), (None, QUESTION)]
    items = [(10, QUESTION), (11, None), (12, ""), (13, "two words"), (None, clean), (14, "seven words stand here for an item")]
    found = leaks(leak_docs(spark, docs), items_of(spark, items)).collect()
    assert {(r.doc_id, r.item_id, r.literal_windows > 0) for r in found} == {(1, 10, True), (2, 10, False), (7, 10, True), (None, 10, True)}
    assert {r.changed_slots for r in found if r.doc_id == 2} == {5} and len(found) == 4
    kept = without_leaks(leak_docs(spark, docs), items_of(spark, items))
    assert rows(kept.select("doc_id")) == [(3,), (4,), (5,), (6,), (8,)] and kept.columns == leak_docs(spark, docs).columns
    short = leaks(leak_docs(spark, [(1, "so, seven words stand here for an ITEM."), (2, "seven words stand here")]), items_of(spark, items)).collect()
    assert [(r.doc_id, r.item_id) for r in short] == [(1, 14)]


def test_wordings_of_one_template_are_apart(spark):
    again = QUESTION.replace("Maria", "Anna").replace("12", "31").replace("3 dollars", "7 dollars").replace("5", "6")
    found = leaks(leak_docs(spark, [(1, OTHER), (2, again), (3, OTHER.replace("does Pavel", "does Olga"))]), items_of(spark, [(10, QUESTION), (11, again), (12, again)])).collect()
    assert {(r.doc_id, r.item_id, r.literal_windows > 0) for r in found} == {(1, 10, False), (2, 10, True)} and len(found) == 2


def test_numbers_that_become_equal(spark):
    equal = QUESTION.replace("12", "4").replace("3 dollars", "4 dollars").replace("5", "4")
    torn = OTHER.replace("on 47 apples", "on 48 apples")
    named = "When does the train of Maria meet the slow train of Pavel if both leave at 3 and go at the same speed?"
    texts = [(1, equal), (2, torn), (3, named.replace("Maria", "Olga").replace("3", "4")), (4, named.replace("Maria", "Olga").replace("Pavel", "Olga"))]
    found = leaks(leak_docs(spark, texts), items_of(spark, [(10, QUESTION), (11, named)])).collect()
    assert {(r.doc_id, r.item_id) for r in found if not r.literal_windows} == {(1, 10), (3, 11)}


def test_short_and_numeric_items(spark):
    items = ["What is 15 percent of 80?", "Solve 12 + 7 * 3 - 4 / 2 + 9 * 8 - 6 for x now please", "Sort these ten numbers for us: 4, 8, 1, 9, 3, 7, 2, 6, 5, 11, then stop", "Is 4 = 4 or not?", "1 2 3 4 5 6 7"]
    texts = ["So: What is 20 percent of 65?", "Solve 5 + 8 * 2 - 9 / 3 + 1 * 4 - 7 for x now please", "Sort these ten numbers for us: 14, 18, 21, 19, 13, 17, 12, 16, 15, 1, then stop", "Is 7 = 7 or not?", "9 8 7 6 5 4 3", "Is 7 = 8 or not?", "What is 20 percent in 65?", "1 2 3 4 5 6 7", "Solve 5 + 8 * 2 - 9 / 3 + 1 * 4 - 7 for y now please"]
    found = leaks(leak_docs(spark, list(enumerate(texts))), items_of(spark, list(enumerate(items)))).collect()
    assert {(r.doc_id, r.item_id, r.literal_windows) for r in found} == {(0, 0, 0), (1, 1, 0), (2, 2, 0), (3, 3, 0), (7, 4, 1)}


def test_leaks_in_blocks_and_of_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = rows(leaks(docs, items).select("doc_id", "item_id"))
    texts, wanted = docs.select("doc_id", "text").collect(), items.collect()
    assert set(found) >= {(d.doc_id, i.item_id) for d in texts for i in wanted if i.text in d.text}
    assert rows(leaks(docs, items, block=100).select("doc_id", "item_id")) == found
    assert leaks(docs.limit(0), items).count() == 0 and leaks(docs, items.limit(0)).count() == 0 and without_leaks(docs, items.limit(0)).count() == 200


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 20):
        data = rng.integers(97, 97 + letters, 700).astype(np.uint8)
        data[300:500] = data[:200]
        text, order = data.tobytes(), suffix_array(data)
        assert order.tolist() == sorted(range(700), key=lambda i: text[i:])
        have = common_prefixes(data, order, 50)
        for r in range(1, 700):
            a, b = text[order[r - 1] :][:50], text[order[r] :][:50]
            assert have[r] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_blocks_merge_as_one():
    rng = np.random.default_rng(6)
    blocks = []
    for b in range(3):
        sizes = rng.integers(40, 90, 12)
        data = rng.integers(97, 99, int(sizes.sum())).astype(np.uint8)
        data[:60] = np.tile([97, 98, 98], 20)
        blocks.append((data, np.concatenate([[0], np.cumsum(sizes)]), rng.integers(0, 5, 12)))
    blocks[1][0][:32] = blocks[0][0][5:37]
    found, seen = string_owners(blocks, 32), {}
    strings = [(k, int(s), d[s : s + 32].tobytes(), int(low[i])) for k, (d, st, low) in enumerate(blocks) for i in range(12) for s in range(st[i], st[i + 1] - 31)]
    for _, _, s, low in strings:
        seen[s] = min(seen.get(s, low), low)
    for k, at, s, low in strings:
        assert found[k][at] == seen[s]
    assert any(seen[s] < low for _, _, s, low in strings)


def strings_by_hand(docs, size):
    first = {}
    raw = [(i, (t or "").encode()) for i, t in docs]
    for i, b in raw:
        for k in range(len(b) - size + 1 if i is not None else 0):
            first[b[k : k + size]] = min(first.get(b[k : k + size], i), i)
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - size + 1 if i is not None else 0):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = [True] * size
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r))


@pytest.mark.parametrize("bucket", [8_000_000, 500])
def test_repeated_strings(spark, bucket):
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("abcdé"), int(rng.integers(2, 9)))) for _ in range(80)]
    docs = [(int(k), " ".join(rng.choice(words, int(rng.integers(0, 60))))) for k in rng.permutation(60)]
    line = " ".join(words[:14])
    docs += [(100 + k, f"{k} {line} {words[k]}") for k in range(30)] + [(200, None), (201, ""), (202, "a" * 4000), (203, "b" + "a" * 70), (204, docs[5][1]), (5, docs[5][1]), (5, line), (None, line), (205, line[:40])]
    docs += [(300, "q" * 30 + "w" * 20), (301, "q" * 30 + "w" * 20)]
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, shard string, bytes int").repartition(3)
    found = drop_repeated_strings(frame, size=50, bucket_bytes=bucket)
    assert rows(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == strings_by_hand(docs, 50)
    for r in found.collect():
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and sum(r.span_ends) - sum(r.span_starts) == r.n_removed
    assert drop_repeated_strings(frame.limit(0)).count() == 0


def test_shards_travel_in_loads(spark, monkeypatch):
    """A load of many shards sends one row to a bucket, and pieces are numbered over all its shards."""
    for name, value in (("SHARD_BYTES", 300), ("LEAST_LOAD", 12), ("MOST_LOAD", 12)):
        monkeypatch.setattr(suffix_arrays, name, value)
    rng = np.random.default_rng(12)
    words = ["".join(rng.choice(list("abc"), int(rng.integers(2, 9)))) for _ in range(90)]
    docs = [(int(k), " ".join(rng.choice(words, int(rng.integers(0, 50))))) for k in rng.permutation(150)]
    passage = " ".join(words[:30])
    docs += [(200 + k, f"{words[k]} {passage[k:]} {words[-k]}") for k in range(40)] + [(300, None), (301, ""), (302, docs[3][1] * 30), (None, passage)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    found = drop_repeated_strings(frame, size=50, with_text=False, bucket_bytes=2_000)
    assert rows(found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) == strings_by_hand(docs, 50)
    shards = suffix_arrays.shards_of(frame, "doc_id", "text").withColumn("load", F.shiftright("shard", 12))
    n_shards, n_loads = shards.agg(F.count("*"), F.countDistinct("load")).first()
    assert n_shards > 4 * n_loads > 8
    sent = suffix_arrays.load_keys(shards, 50, 16).groupBy("load", "bucket").count().collect()
    assert {r["count"] for r in sent} == {1} and len(sent) > 8 * n_loads
    # Rows between loads and buckets: in proportion to the input, not to its square, from 256 MB to 8 GB.
    assert [suffix_arrays.load_bits(n) for n in (0, 1 << 28, 1 << 30, 1 << 40)] == [12] * 4
    monkeypatch.undo()
    assert [suffix_arrays.load_bits(n) for n in (0, 1 << 27, 1 << 30, 1 << 40)] == [20, 20, 23, 25]


def test_strings_whose_hash_comes_once_skip_the_arrays(monkeypatch):
    rng = np.random.default_rng(3)
    same = rng.integers(97, 123, 60).astype(np.uint8)
    texts = [rng.integers(low, low + 26, 400).astype(np.uint8) for low in (97, 97, 97, 65)]
    texts[1][100:160] = texts[3][200:260] = same
    data, sizes = np.concatenate(texts), np.full(4, 400)
    seen, arrays = [], suffix_arrays.string_owners
    monkeypatch.setattr(suffix_arrays, "string_owners", lambda blocks, size: seen.extend(blocks) or arrays(blocks, size))
    owner = suffix_arrays.first_owners(data, np.cumsum(sizes) - sizes, sizes - 49, np.array([9, 7, 8, 5]), 50, 1 << 20)
    want = np.repeat([9, 7, 8, 5], 351)
    want[351 + 100 : 351 + 111] = 5
    assert owner.tolist() == want.tolist() and sum(len(data) for data, _, _ in seen) == 120
