import numpy as np
import pytest

from lectern.llm.components import connected_components
from lectern.llm.line_windows import drop_repeated_lines
from lectern.llm.simhash import fingerprint_rows, fingerprints, near_copies, near_links, shingle_hashes, variant_index, without_near_copies
from tests.conftest import rows

SCHEMA = "doc_id long, text string, fp string, component_id int, key long, id string, covered int, node string"


def table(spark, pairs):
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, "z") for i, t in pairs], SCHEMA)


def roots(n, linked):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))] + [(70 + i, 71 + i) for i in range(20)] + [(5, 5)]
    want = roots(100, pairs)
    found = connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    assert {r.node: r.root for r in found} == {i: want[i] for p in pairs if p[0] != p[1] for i in p}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_fingerprint_by_hand():
    text = "The  CAT\tsat on É"
    hashes = shingle_hashes(text, 3)
    assert hashes == [h for s in ("the cat sat", "cat sat on", "sat on É") for h in shingle_hashes(s, 3)]
    want = sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > 3)
    assert fingerprint_rows([text, None, "", " \n", "one"], 3).view(np.uint64).tolist() == [want, 0, 0, 0, shingle_hashes("one", 3)[0]]


def test_fingerprints_of_long_texts():
    texts = ["a b c d " * 30_000, "x", "q w e r t y " * 15_000]
    apart = [int(fingerprint_rows([t], 3)[0]) for t in texts]
    assert fingerprint_rows(texts, 3).tolist() == apart


@pytest.mark.parametrize("hot_key", [20_000, 3])
def test_links_connect_what_is_near(spark, hot_key):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 12).tolist()
    fps = set(base)
    for b in base[:6]:
        for _ in range(25):
            b ^= sum(1 << int(k) for k in set(rng.integers(0, 64, int(rng.integers(1, 5))).tolist()))
            fps.add(b)
    fps = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    u = np.array(fps).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 3
    want = roots(len(fps), [(i, j) for i, j in zip(*np.nonzero(near)) if i < j])
    links = [(fps.index(r.a), fps.index(r.b)) for r in near_links(spark.createDataFrame([(x,) for x in fps], "fp long"), hot_key=hot_key).collect()]
    assert roots(len(fps), links) == want and all(want[a] == want[b] for a, b in links)


def test_each_fingerprint_has_its_variants(spark):
    assert variant_index(spark.createDataFrame([(-1,), (0,)], "fp long")).distinct().count() == 128


def test_groups(spark):
    texts = [(4, "a b c d e"), (2, "A b  c d e"), (9, None), (7, ""), (8, " "), (1, "z y x w v u"), (4, "a b c d e"), (None, "a b c d e")]
    found = rows(near_copies(table(spark, texts)).select("doc_id", "component_id"))
    assert found == sorted([(1, 1), (2, 2), (4, 2), (4, 2), (7, 7), (8, 7), (9, 7), (None, 2)], key=lambda r: tuple((v is None, v) for v in r))
    kept = without_near_copies(table(spark, texts))
    assert kept.columns == table(spark, texts).columns
    assert rows(kept.select("doc_id")) == [(1,), (2,), (7,), (None,)]
    assert near_copies(table(spark, texts).limit(0)).count() == 0 and without_near_copies(table(spark, texts).limit(0)).count() == 0
    assert fingerprints(table(spark, texts)).count() == 8


def test_one_document_of_each_group_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    docs = [(r.doc_id, r.text) for r in docs] + [(1000, None), (1001, "  "), (1002, docs[3].text.upper()), (3, docs[3].text)]
    fps = fingerprint_rows([t for _, t in docs], 3).view(np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3
    want = roots(len(docs), [(i, j) for i, j in zip(*np.nonzero(near)) if i < j])
    least = sorted(min(docs[i][0] for i in range(len(docs)) if want[i] == k) for k in set(want))
    assert len(least) < len(docs) - 5
    assert rows(without_near_copies(table(spark, docs)).select("doc_id")) == [(i,) for i in least]


def lines_by_hand(docs, size=3):
    first = {}
    for i, t in sorted((i, t) for i, t in docs if t is not None):
        lines = t.split("\n")
        for p in range(len(lines) - size + 1):
            w = tuple(lines[p : p + size])
            if "".join(w).strip(" "):
                first.setdefault(w, (i, p))
    out = {}
    for i, t in docs:
        lines, gone = (t.split("\n") if t is not None else []), set()
        for p in range(len(lines) - size + 1):
            if first.get(tuple(lines[p : p + size]), (i, p)) < (i, p):
                gone.update(range(p, p + size))
        out[i] = (None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone), len(lines), len(gone), sum(p - 1 not in gone for p in gone))
    return out


def test_line_windows(spark):
    rng = np.random.default_rng(2)
    docs = [(k, "\n".join("abcde"[j] for j in rng.integers(0, 3, int(rng.integers(1, 9))))) for k in range(60)]
    docs += [(90, None), (91, ""), (92, "\n\n\n\n"), (93, "\n\n\n\n"), (94, "é\nü\nz"), (95, "q\né\nü\nz\nq"), (96, "a\n" * 5000)]
    found = drop_repeated_lines(table(spark, docs)).select("doc_id", "text", "_lines_n", "_lines_removed", "_lines_spans")
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == lines_by_hand(docs)
    odd = drop_repeated_lines(table(spark, [(None, "a\nb\nc"), (1, "a\nb\nc"), (1, "a\nb\nc"), (2, "a\nb\nc\nd")]))
    assert odd.columns[:8] == table(spark, []).columns
    assert rows(odd.select("doc_id", "text")) == [(1, "a\nb\nc"), (1, "a\nb\nc"), (2, "d"), (None, "a\nb\nc")]
    assert drop_repeated_lines(table(spark, [])).count() == 0
