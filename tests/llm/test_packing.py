import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lectern.llm.packing import Capacities, best_fit, cost_balanced, id_matrix, pack_best_fit, pack_by_cost, write_packed
from lectern.llm.token_ids import Vocabulary, worker_pieces

ODD = ["", " ", "a", "\n", "a b\n", "two  spaces", "tab\there", "don't we'll\nit's", "naïve café  x", "’s “q”", "日本 語", "<|endoftext|> x", "<|endoftext|>", "a<|endoftext|>b", " <|endoftext|> ", "a <|endoftext|>", "<|endoftext|><|endoftext|>\n", "<|endof", "text|>", "a <|endoftext| b", "plain words", "x" * 300 + " " + "y" * 70, "1,234.5 a²", " a", "\x1cz \x85", " lead", "é\n\nç"]


def reference():
    t = Tokenizer.from_file(Vocabulary().path)
    return lambda s: t.encode(s, add_special_tokens=False).ids


def encoded(texts, end=None):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ids, places = worker_pieces(Vocabulary()).encode(data, np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), end)
    return [ids[places[i] : places[i + 1]].tolist() for i in range(len(texts))]


def test_ids_are_those_of_the_tokenizer():
    own = reference()
    assert encoded(ODD) == [own(t) for t in ODD]
    assert encoded(ODD, 0) == [[*own(t), 0] for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text(st.characters(max_codepoint=0x2100, exclude_categories=["Cs"]), max_size=30), st.text("ab'St \nñ²,1", max_size=30), st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "a b", "é", "\n"]), max_size=6).map("".join)), max_size=6))
def test_ids_of_any_text(texts):
    own = reference()
    assert encoded(texts) == [own(t) for t in texts]


lengths = st.lists(st.integers(0, 300), max_size=60).map(lambda n: np.array(n, np.int64))


def whole(sequences, n, capacity):
    ids = [(i, k) for s in sequences for i, start, m in s for k in range(start, start + m)]
    assert sorted(ids) == [(i, k) for i, m in enumerate(n.tolist()) for k in range(m)]
    assert all(0 < sum(p[2] for p in s) <= capacity and all(p[2] > 0 for p in s) for s in sequences)


@given(lengths)
def test_cost_balanced_has_no_padding(n):
    sequences = cost_balanced(n, 64)
    whole(sequences, n, 64)
    assert all(sum(p[2] for p in s).bit_count() == 1 for s in sequences)


@given(lengths)
def test_best_fit_is_best_fit(n):
    sequences = best_fit(n, 64)
    whole(sequences, n, 64)
    rest = sorted(((m % 64, -i) for i, m in enumerate(n.tolist()) if m % 64), reverse=True)
    bins = []
    for size, _ in rest:
        fits = [k for k, room in enumerate(bins) if room >= size]
        if fits:
            bins[min(fits, key=lambda k: bins[k])] -= size
        else:
            bins.append(64 - size)
    rooms = sorted(64 - sum(p[2] for p in s) for s in sequences)
    assert rooms == sorted(bins + [0] * sum(m // 64 for m in n.tolist()))


def test_lowest_cost_that_has_room():
    rng, free, open_ = np.random.default_rng(1), Capacities(64), {}
    for k in range(200):
        size = int(rng.integers(1, 65))
        fit = [(c, j, r) for j, (r, c) in open_.items() if r >= size]
        assert free.least_key(size) == (min(fit)[2] if fit else None)
        assert free.least_room(size) == (min(r for _, _, r in fit) if fit else None)
        open_[k] = (int(rng.integers(0, 65)), float(rng.integers(0, 9)))
        free.put(*open_[k], k)


def table(spark, texts, ids=None):
    ids = ids or list(range(len(texts)))
    return spark.createDataFrame([(i, t, "x", 7) for i, t in zip(ids, texts)], "doc_id long, text string, ids string, length int")


def test_pieces_hold_each_id_once(spark):
    texts = [*ODD, None, "word " * 900 + "end", "same", "same"]
    found = pack_by_cost(table(spark, texts).repartition(3), capacity=128, group_tokens=700).collect()
    own = reference()
    docs = {i: [*own(t or ""), 0] for i, t in enumerate(texts)}
    seen, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        ids = docs[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(docs[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        seen[r.doc_id].extend(range(r.start, r.start + r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in seen.items()} == {k: list(range(len(v))) for k, v in docs.items()}
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 128 and at.bit_count() == 1


def test_matrices_give_the_texts_back(spark, tmp_path):
    texts = [*ODD, None, "word " * 900 + "end", "same", "same"]
    write_packed(pack_best_fit(table(spark, texts), capacity=128), str(tmp_path / "packed"))
    rows_ = spark.read.parquet(str(tmp_path / "packed")).collect()
    parts = defaultdict(dict)
    ids, at = id_matrix([r.ids for r in rows_], 128), id_matrix([r.positions for r in rows_], 128)
    for line, places, r in zip(ids, at, rows_):
        assert r.cu_seqlens[-1] == r.n_tokens and not line[r.n_tokens :].any() and not places[r.n_tokens :].any()
        for a, b, d, s in zip(r.cu_seqlens, r.cu_seqlens[1:], r.doc_ids, r.starts):
            parts[d][s] = line[a:b].tolist()
            assert places[a:b].tolist() == list(range(b - a))
    t = Tokenizer.from_file(Vocabulary().path)
    back = {d: t.decode([i for _, x in sorted(p.items()) for i in x], skip_special_tokens=False) for d, p in parts.items()}
    assert back == {i: t for i, t in enumerate(texts) if t}


@pytest.mark.parametrize("pack", [pack_by_cost, pack_best_fit])
def test_nothing_to_pack(spark, pack):
    assert pack(table(spark, ["a"]).limit(0)).count() == 0
    assert pack(table(spark, ["a b", "a b"], [None, None])).count() > 0
