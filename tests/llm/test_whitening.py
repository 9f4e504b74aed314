"""Whitening against numpy's own eigenvalues and Python's whole numbers."""

import math

import numpy as np
import pytest

from newsloom.llm import whitening as W


def given(rng, n, d, factors=None):
    x = rng.normal(size=(n, factors or d)) @ rng.normal(size=(factors or d, d)) * 0.3
    return x.astype("f4").tolist()


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, d int, n string")


def plain(vectors):
    """Exact x, sums, deviations and the covariance in Python's numbers."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, s = len(x), [sum(c) for c in zip(*x)]
    z = [[n * c - t for c, t in zip(v, s)] for v in x]
    cov = [[sum(v[i] * v[j] for v in z) / n**3 for j in range(len(s))] for i in range(len(s))]
    return n, z, [sum(c * c for c in v) for v in z], np.array(cov)


@pytest.mark.parametrize("n, d, k", [(300, 40, 32), (200, 5, 32), (60, 12, 4)])
def test_against_numpy(spark, n, d, k):
    vectors = given(np.random.default_rng(n), n, d)
    got = W.by_component(W.whiten(frame(spark, [(i, v, 1, "x") for i, v in enumerate(vectors)]).repartition(5), k)).collect()
    count, z, deviation, cov = plain(vectors)
    values, components = np.linalg.eigh(cov)
    values, components = values[::-1], components[:, ::-1]
    assert len(got) == n * min(d, k)
    w = np.zeros((n, min(d, k)))
    for r in got:
        assert (r.n, r.deviation) == (count, deviation[r.vec_id])
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(cov), rel=1e-9)
        assert r.identity_error < 1e-9
        w[r.vec_id, r.component - 1] = r.whitened
    expected = (np.array(z, float) / n) @ components[:, : w.shape[1]] / np.sqrt(values[: w.shape[1]])
    expected *= np.sign((expected * w).sum(axis=0))
    assert np.abs(w - expected).max() < 1e-7


@pytest.mark.parametrize("case", ["random", "equal", "clusters", "split", "zero", "rank", "one", "two", "graded"])
def test_eigenvalues_and_vectors(case):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(50, 50)))
    near = np.repeat([9.0, 4.0, 1.0], [5, 25, 20]) * (1 + 1e-15 * rng.normal(size=50))
    a = {
        "random": lambda: (lambda x: x @ x.T)(rng.normal(size=(50, 80))),
        "equal": lambda: 7.0 * np.eye(40),
        "clusters": lambda: (q * near) @ q.T,
        "split": lambda: np.kron(np.eye(8), (lambda x: x @ x.T)(rng.normal(size=(5, 9)))),
        "zero": lambda: np.zeros((6, 6)),
        "rank": lambda: (lambda x: x @ x.T)(rng.normal(size=(50, 7))),
        "one": lambda: np.array([[3.0]]),
        "two": lambda: np.array([[2.0, 1e-9], [1e-9, 2.0]]),
        "graded": lambda: (q * 10.0 ** -np.arange(0, 12.5, 0.25)) @ q.T,
    }[case]()
    a = (a + a.T) / 2
    k = min(32, len(a))
    values, vectors = W.leading(a, k)
    size = max(np.abs(a).max(), 1e-300) * len(a)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-14 * size
    assert np.abs(a @ vectors - vectors * values).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12


def test_odd_rows(spark):
    vectors = given(np.random.default_rng(1), 50, 3)
    rows = [(i, v, 1, "x") for i, v in enumerate(vectors)]
    odd = [(None, vectors[0], 1, None), (7, vectors[7], 1, "again"), (90, None, 1, ""), (91, [], 1, ""), (92, [1.0, None, 2.0], 1, ""),
           (93, [float("nan"), 0.0, 0.0], 1, ""), (94, [0.0, float("-inf"), 0.0], 1, ""), (95, [1.0, 2.0], 1, ""), (96, [3.0, 2.0], 1, "")]
    got = W.by_component(W.whiten(frame(spark, rows + odd))).collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == [*range(50), 95, 96]
    n, _, deviation, _ = plain(vectors + [vectors[0], vectors[7]])
    three = [r for r in got if r.vec_id not in (95, 96)]
    assert len(three) == 52 * 3 and {r.n for r in three} == {n}
    assert sorted(r.deviation for r in three if r.component == 1) == sorted(deviation)
    two = {(r.vec_id, r.component): r for r in got if r.vec_id in (95, 96)}
    assert abs(two[95, 1].whitened) == pytest.approx(1) and two[95, 1].explained == 1
    assert two[95, 2].whitened is None and two[95, 2].explained == 0


def test_without_variance(spark):
    got = W.by_component(W.whiten(frame(spark, [(1, [1.0, 2.0], 1, ""), (2, [1.0, 2.0], 1, "")]))).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(c, 2, 0, None, None, None) for c in (1, 2)] * 2


def test_empty_table(spark):
    assert W.by_component(W.whiten(frame(spark, []))).collect() == []
    assert W.by_component(W.whiten(frame(spark, [(1, None, 1, "")]))).collect() == []


def test_large_entries(spark):
    rows = [(1, [1e30, 0.0], 1, ""), (2, [-3.0e38, 1.0], 1, ""), (3, [5.0, 2.0], 1, "")]
    got = {(r.vec_id, r.component): r for r in W.by_component(W.whiten(frame(spark, rows))).collect()}
    assert got[1, 1].deviation is None and len(got) == 6
    assert abs(got[1, 1].whitened) == pytest.approx(abs(got[2, 1].whitened))
