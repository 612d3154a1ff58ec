import hashlib
import itertools
import re

import numpy as np
import pytest

from lectern.llm import char_tagger as ct
from lectern.llm import personal_data as pd
from lectern.llm.queries import LLM_QUERIES

FOLDER = "/root/testdata/sf0.01"
SMALL = pd.Settings(windows=800, steps=150, batch=48)

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn_by_hand(digits):
    total = 0
    for k, d in enumerate(digits[::-1]):
        total += sum(map(int, str(int(d) * 2))) if k % 2 else int(d)
    return total % 10 == 0


def base_by_hand(text):
    out = []
    for k, (name, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if name == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if name == "card" and not (12 <= len(digits) <= 19 and luhn_by_hand(digits)):
                continue
            if name == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_patterns_by_their_definition():
    rng = np.random.default_rng(4)
    alphabet = list("a.@-+%_1 25(0)9é\n") + ["1.2.3.4", "a@b.c", "+1 (017) 555-7713", "4111 1111 1111 1111", "4111111111111111", "300.1.1.1", "00255.1.1.1"]
    for _ in range(4000):
        text = "".join(alphabet[k] for k in rng.integers(0, len(alphabet), int(rng.integers(0, 24))))
        assert pd.base_spans(text) == base_by_hand(text), text


@pytest.mark.parametrize("text", ["a" * 300_000, "a@" * 100_000, "1" * 300_000, "1." * 100_000, "+1" + " " * 200_000, "1 " * 150_000, "+1-" * 100_000])
def test_patterns_take_linear_time(text):
    pd.base_spans(text)


def naive_scores(model, classes):
    """One character after the other, in doubles."""
    n = model.hidden
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    states = np.zeros((len(classes), 2 * n))
    for side, order in enumerate((range(len(classes)), range(len(classes) - 1, -1, -1))):
        h, c = np.zeros(n), np.zeros(n)
        for t in order:
            z = model.sides[side].astype(float) @ np.concatenate([h, model.embedding[:, classes[t]], [1]])
            c = sigmoid(z[n : 2 * n]) * c + sigmoid(z[:n]) * np.tanh(z[3 * n :])
            h = sigmoid(z[2 * n : 3 * n]) * np.tanh(c)
            states[t, side * n : (side + 1) * n] = h
    return states @ model.out[:, :-1].T.astype(float) + model.out[:, -1]


def small_model(seed=3):
    model = ct.Tagger.random(2, 3, 4, seed)
    rng = np.random.default_rng(seed)
    model.moves[:] = rng.normal(size=model.moves.shape)
    model.first[:] = rng.normal(size=model.first.shape)
    return model


def test_scores_equal_a_naive_pass():
    model, texts = small_model(), ["Mail a@b.org now", "é", "12 34\n", "plain words and more of them"]
    texts.sort(key=len, reverse=True)
    lengths = np.array([len(t) for t in texts])
    ids = np.zeros((lengths.max(), len(texts)), np.uint8)
    for k, t in enumerate(texts):
        ids[: len(t), k] = ct.char_classes(t)
    scores, _ = ct.emissions(model, ids, lengths)
    for k, t in enumerate(texts):
        assert np.allclose(scores[: len(t), :, k], naive_scores(model, ct.char_classes(t)), atol=1e-5)


def path_score(model, scores, path):
    moves, first = model.barred()
    return first[path[0]] + sum(scores[t, k] for t, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))


def test_best_labels_and_likelihood_equal_all_paths():
    model = small_model(8)
    ids = np.array([ct.char_classes("a1@"), ct.char_classes("+ x")], np.uint8).T
    full = np.full(2, 3)
    scores, _ = ct.emissions(model, ids, full)
    told = ct.best_labels(model, scores, full)
    labels = np.array([[1, 2, 0], [0, 3, 4]], np.uint8).T
    want = 0
    for w in range(2):
        paths = list(itertools.product(range(5), repeat=3))
        each = np.array([path_score(model, scores[:, :, w], p) for p in paths], float)
        assert tuple(told[:, w]) == paths[int(each.argmax())]
        want += np.logaddexp.reduce(each) - path_score(model, scores[:, :, w], tuple(labels[:, w]))
        assert w in ct.may_leave(model, scores, full) or not told[:, w].any()
    assert np.isclose(ct.loss_and_gradients(model, ids, labels)[0], want / 2, rtol=1e-4)


def test_gradients_equal_differences():
    model = small_model(9)
    ids = np.array([ct.char_classes("ab1@."), ct.char_classes("+1 2x")], np.uint8).T
    labels = np.array([[0, 1, 2, 0, 0], [3, 4, 4, 0, 1]], np.uint8).T
    for p, slope in zip(model.parameters(), ct.loss_and_gradients(model, ids, labels)[1]):
        flat = p.reshape(-1)
        for k in np.argsort(-np.abs(slope).reshape(-1))[:12]:
            before, h = flat[k], 1e-2
            flat[k] = before + h
            up = ct.loss_and_gradients(model, ids, labels)[0]
            flat[k] = before - h
            down = ct.loss_and_gradients(model, ids, labels)[0]
            flat[k] = before
            assert np.isclose((up - down) / (2 * h), slope.reshape(-1)[k], rtol=0.03, atol=2e-3)


def test_windows_cover_whole_texts():
    for size in (0, 1, pd.WINDOW, pd.WINDOW + 1, 5000, 448 * 3 + 64, 448 * 3 + 65):
        starts = pd.windows_of(size)
        covered = sum(min(size, a + pd.WINDOW) - a for a in starts) - (len(starts) - 1) * pd.SHARED
        assert starts[0] == 0 and covered == size


def test_windows_left_unread_hold_nothing_plausible(finder, monkeypatch):
    """All windows are read, without the test of what they hold: what is added is the same."""
    rng = np.random.default_rng(31)
    words = ["thonble", "shre", "that", "at", "At", "rethsh.", "12", "x@", "dot"]
    texts = []
    for i in range(60):
        parts = [words[k] for k in rng.integers(0, len(words), int(rng.integers(1, 400)))]
        if i % 2:
            parts.insert(int(rng.integers(0, len(parts))), pd.variant(rng, i // 2 % 4, ["thonble", "shre"]))
        texts.append(" ".join(parts))
    texts += ["", "a", "at", "1", "a" * 2000, "at " * 700]
    own = [pd.reconciled(finder, t, pd.base_spans(t), p) for t, p in zip(texts, pd.proposals(finder, texts))]
    monkeypatch.setattr(pd, "open_windows", lambda c: [(a, min(pd.WINDOW, len(c) - a)) for a in pd.windows_of(len(c)) if len(c)])
    assert own == [pd.reconciled(finder, t, pd.base_spans(t), p) for t, p in zip(texts, pd.proposals(finder, texts))]
    assert any(own)


@pytest.fixture(scope="module")
def finder(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return pd.fit(docs.select("doc_id", "text"))


def added_of(finder, text):
    return pd.reconciled(finder, text, pd.base_spans(text), pd.proposals(finder, [text])[0])


def test_tagger_finds_held_out_forms_and_leaves_others(finder):
    rng = np.random.default_rng(77)
    words = ["thonble", "shre", "hewhha", "rethsh"]
    missed = [0, 0]
    for i in range(600):
        item = pd.variant(rng, i % 4, words)
        text = f"Thonble shre hewhha {item} rethsh on toon"
        spans = pd.base_spans(text)
        if not spans:
            missed[0] += 1
            missed[1] += (20, i % 4, 20 + len(item)) in added_of(finder, text)
    assert missed[0] > 200 and missed[1] > 0.6 * missed[0]
    false = [added_of(finder, f"Thonble shre hewhha {pd.distractor(rng, words)} rethsh on toon") for _ in range(600)]
    assert sum(map(bool, false)) <= 6


def test_spans_near_window_edges(finder):
    """An item is found wherever windows begin and end around it."""
    item, told = "149[.]92[.]148[.]197", []
    for lead in range(380, 530, 3):
        text = ("thonble shre hewhha " * 40)[: lead - 1] + " " + item + " rethsh on toon" * 30
        spans = added_of(finder, text)
        assert len(spans) <= 1
        told.append(spans == [(lead, pd.IP, lead + len(item))])
    # The second window begins at 448, the first one ends at 512.
    assert all(told) or np.mean(told) > 0.9 and np.mean(told[17:]) > 0.9


def test_query_on_whole_table(spark):
    found = {r.doc_id: r for r in LLM_QUERIES["op11_personal_data"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert len(found) == len(docs)
    for r in docs:
        own, base = found[r.doc_id], base_by_hand(r.text)
        assert [own.n_email, own.n_ip, own.n_card, own.n_phone] == [sum(k == j for _, k, _ in base) for j in range(4)]
        written = [f"{pd.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert own.base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest()
        spans = own.spans.split(",") if own.spans else []
        assert set(written) <= set(spans) and len(spans) == len(base) + own.n_added
        order = [(int(s.split(":")[1]), pd.KINDS.index(s.split(":")[0])) for s in spans]
        assert order == sorted(order)
    assert sum(found[r.doc_id].n_added for r in docs) <= 0.01 * len(docs)


def test_odd_rows(spark):
    schema = "doc_id long, text string, base string, added int, n_email string, spans int"
    texts = [(1, None), (2, ""), (3, "a@b.org and é 1.2.3.4"), (3, "a@b.org and é 1.2.3.4"), (None, "call +1 (017) 555-7713"), (4, "word " * 60_000 + "x@y.de"), (5, "🙂 x@y.de")]
    docs = spark.createDataFrame([(i, t, "x", 1, "y", 2) for i, t in texts], schema)
    found = {(r.doc_id, r.spans): r for r in pd.personal_data(docs, settings=SMALL).collect()}
    assert len(found) == 6
    assert found[3, "email:0:7,ip:14:21"].n_email == 1 and found[None, "phone:5:22"].n_phone == 1
    assert found[4, "email:300000:300006"].n_email == 1 and found[5, "email:2:8"].n_email == 1
    assert found[1, ""].base_sha256 == found[2, ""].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pd.personal_data(docs.limit(0), settings=SMALL).count() == 0
    nothing = pd.personal_data(spark.createDataFrame([(1, "plain words"), (2, None)], "doc_id long, text string"), settings=SMALL)
    assert sorted((r.doc_id, r.spans, r.n_added) for r in nothing.collect()) == [(1, "", 0), (2, "", 0)]
