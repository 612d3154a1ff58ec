import math

import numpy as np
import pytest

from lectern.llm.queries import LLM_QUERIES
from lectern.llm.whitening import refined, whiten

FOLDER = "/root/testdata/sf0.01"


def symmetric(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values), len(values))))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    v = (q * np.asarray(values, np.longdouble)) @ q.T
    return ((v + v.T) / 2).astype(np.float64), q


def residuals(v, values, x):
    wide, x = v.astype(np.longdouble), x.astype(np.longdouble)
    return float(np.abs(wide @ x - x * values).max()), float(np.abs(x.T @ x - np.eye(len(v))).max())


CASES = {
    "spread": np.geomspace(1e4, 1e-4, 24),
    "clustered": np.concatenate([1 + 1e-10 * np.arange(5), 0.5 + 1e-8 * np.arange(5), np.linspace(2, 3, 10), [0.1] * 3]),
    "equal": np.ones(12),
    "single precision cannot tell": np.concatenate([[1 + 1e-9, 1, 1 - 1e-9], [1e-3] * 4, [0] * 5]),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_refined_vectors_are_of_double_precision(name):
    wanted = np.sort(CASES[name])[::-1]
    v, _ = symmetric(wanted, 3)
    values, x = refined(v)
    size = max(1, len(v) ** 0.5) * np.abs(wanted).max()
    off, lost = residuals(v, values, x)
    assert off < 1e-15 * size * 4 and lost < 2e-15
    assert np.allclose(values, wanted, rtol=0, atol=2e-15 * size)
    assert (np.diff(values) <= 0).all()


def test_refined_vectors_of_near_values():
    """Vectors whose values differ by 1e-9 of the largest are found to the digits that their gap leaves."""
    wanted = np.array([3, 2, 1 + 1e-9, 1, 0.5, 0.25])
    v, q = symmetric(wanted, 5)
    _, x = refined(v)
    told = np.abs(np.diag(q.T @ x.astype(np.longdouble)).astype(float))
    assert (1 - told < 1e-12).all()
    single = np.abs(np.diag(q.T @ np.linalg.eigh(v.astype(np.float32))[1][:, ::-1].astype(np.longdouble)).astype(float))
    assert single.min() < 0.999


def test_refined_odd_matrices():
    assert refined(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert refined(np.array([[2.0]]))[0].tolist() == [2.0]


def by_hand(vectors):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    y = x - total / n
    v = y.T @ y / n
    values, basis = np.linalg.eigh(v)
    deviation = ((x * n - total) ** 2).sum(axis=1)
    return n, deviation, y @ basis[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300)), values[::-1] / np.trace(v)


def test_query_equals_brute_force(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    n, deviation, white, explained = by_hand(list(vectors.values()))
    found = LLM_QUERIES["op13_whitening"](spark, FOLDER).collect()
    assert len(found) == 8 * n and {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1
    assert found[0].identity_error < 1e-12
    at = {i: k for k, i in enumerate(vectors)}
    sign = {}
    for r in found:
        k, c = at[r.vec_id], r.component - 1
        assert r.deviation == deviation[k] and math.isclose(r.explained, explained[c], rel_tol=1e-9)
        s = sign.setdefault(c, np.sign(r.whitened * white[k, c]))
        assert math.isclose(r.whitened, s * white[k, c], rel_tol=1e-6, abs_tol=1e-9)


def table(spark, found):
    return spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in found], "vec_id long, embedding array<float>, component int, v string, n double")


def test_odd_vectors(spark):
    good = [(1, [0.5, 0.25, 1.0]), (2, [0.0, 0.75, 1.0]), (3, [1.0, 0.0, 1.0]), (3, [1.0, 0.0, 1.0]), (None, [0.25, 0.5, 1.0])]
    odd = [(5, None), (6, []), (7, [1.0, None, 2.0]), (8, [float("nan"), 0.0, 0.0]), (9, [float("inf"), 0.0, 0.0]), (10, [1.0])]
    found = whiten(table(spark, good + odd)).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.component) for r in found) == sorted((i is None, i or 0, c) for i, _ in good for c in (1, 2, 3))
    _, deviation, white, _ = by_hand([v for _, v in good])
    assert {r.deviation for r in found if r.vec_id == 1} == {deviation[0]}
    # The third dimension never varies.
    assert all(r.whitened is None and r.explained < 1e-12 for r in found if r.component == 3)
    assert all(r.whitened is not None and r.identity_error < 1e-9 for r in found if r.component == 1)
    one = whiten(table(spark, good[:1])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, 0.0, None)] * 3
    assert whiten(table(spark, [])).count() == 0 and whiten(table(spark, odd[:5])).count() == 0


def test_deviation_beyond_64_bits(spark):
    found = whiten(table(spark, [(1, [2.0**50, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])])).collect()
    assert {r.deviation for r in found if r.vec_id == 1} == {None}
    small = whiten(table(spark, [(1, [2.0**14, 0.0]), (2, [0.0, 0.0]), (3, [0.0, 1.0])])).collect()
    assert {r.deviation for r in small if r.vec_id == 1} == {(2 << 24) ** 2 + 1024**2}
