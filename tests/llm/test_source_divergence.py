import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from lectern.llm import source_divergence as sd
from tests.conftest import rows

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, value int, rank string"


def table(spark, docs):
    return spark.createDataFrame([(k, *d, "x", 1, 2, "y") for k, d in enumerate(docs)], SCHEMA)


def by_hand(docs, least=3, top=200):
    plain = [(t or "", lang or "", s or "") for t, lang, s in docs]
    terms = [[re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)] for t, _, _ in plain]
    out = []
    for lang in {d[1] for d in plain}:
        own = [(w, s) for w, (_, l, s) in zip(terms, plain) if l == lang]
        df = Counter(x for w, _ in own for x in set(w))
        kept = sorted(x for x, n in df.items() if n >= least)
        counts = defaultdict(Counter)
        for w, s in own:
            counts[s].update(x for x in w if df[x] >= least)
        whole = sum(counts.values(), Counter())

        def share(c):
            total = sum(c.values()) + len(kept)
            return {x: 1 + 10**9 * (c[x] + 1) // total for x in kept}

        shares, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s, p in shares.items():
            pairs = [(sum((p[x] - o[x]) ** 2 // o[x] for x in kept), item) for item, o in shares.items() if item != s]
            best = [((p[x] - q[x]) ** 2 // q[x], x) for x in kept if counts[s][x] > 0 and p[x] > q[x]]
            for part, found in (("pair", pairs), ("term", best)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def random_docs(seed, n):
    rng = np.random.default_rng(seed)
    words = ["Apple", "apple", "bär", "ÄPFEL", "x1y", "don't", "日本", "z\x7fq", "the", "of"] + [f"w{'abcdefgh'[k % 8]}{'ijklmnop'[k // 8]}" for k in range(40)]
    docs = []
    for _ in range(n):
        own = [words[int(k)] for k in rng.zipf(1.4, int(rng.integers(0, 40))) % len(words)]
        docs.append((" ".join(own), ["en", "de", None][int(rng.integers(0, 3))], ["a", "b", "c", "", None, "ä"][int(rng.integers(0, 6))]))
    return docs + [(None, "en", "silent"), ("", "fr", "a"), ("once", "fr", "b"), ("one two", None, None), ("Apple " * 50_000, "en", "a")]


def found(spark, docs, **ways):
    return rows(sd.source_divergences(table(spark, docs), **ways).select("lang", "source", "part", "item", "value", "rank"))


def test_equals_brute_force(spark):
    docs = random_docs(1, 150)
    want = by_hand(docs)
    assert {w[2] for w in want} == {"pair", "term"}
    assert found(spark, docs) == want


def test_spills_and_joined_totals_change_nothing(spark):
    docs = random_docs(2, 80)
    assert found(spark, docs, most=7, carried=0) == by_hand(docs)
    assert found(spark, docs, top=3, least=1, most=50) == by_hand(docs, least=1, top=3)


def test_many_sources_and_a_hot_one(spark):
    rng = np.random.default_rng(5)
    docs = [(" ".join(f"t{'abcdefghij'[int(k)]}" for k in rng.integers(0, 10, 6)), "en", "hot" if i % 3 == 0 else f"s{i % 37}") for i in range(200)]
    assert found(spark, docs) == by_hand(docs)


def test_no_rows_one_source_no_terms(spark):
    assert found(spark, []) == []
    assert found(spark, [("a a a", "en", "s")] * 3) == by_hand([("a a a", "en", "s")] * 3)
    quiet = [("a", "en", "s"), ("b", "en", "t"), (None, "en", None)]
    assert found(spark, quiet) == by_hand(quiet)
    assert {r[4] for r in found(spark, quiet)} == {0}


def test_shares_beyond_64_bits():
    count, total = np.array([0, 5, 10**13]), np.array([10**13] * 3)
    assert sd.share(count, total, np.array([7] * 3)).tolist() == [1 + 10**9 * (int(c) + 1) // (10**13 + 7) for c in count]


def test_runs_over_batches_merge():
    cells = [("en", "a", 1, ["s"], [2]), ("en", "a", 1, ["t", "s"], [1, 1]), ("en", "a", 2, ["t"], [5]), ("en", "b", 1, ["s"], [1]), ("fr", "b", 3, ["s"], [9])]
    batches = [pa.RecordBatch.from_pylist([dict(zip(sd.STRIPES.names, c))], schema=sd.STRIPES) for c in cells]
    merged = [r for b in sd.merge_runs(iter(batches), 3) for r in b.to_pylist()]
    assert [(r["lang"], r["term"], r["df"], dict(zip(r["sources"], r["counts"]))) for r in merged] == [("en", "a", 4, {"s": 3, "t": 6}), ("fr", "b", 3, {"s": 9})]
