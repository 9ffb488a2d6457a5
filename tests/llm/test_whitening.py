"""Whitening against numpy's eigenvectors and whole-number sums."""

import math

import numpy as np
import pytest

from monthmill.llm import whitening
from monthmill.llm.queries import op12_embedding_whitening


def matrices():
    rng = np.random.default_rng(4)
    a = rng.normal(size=(40, 40))
    yield "dense", a @ a.T
    q = np.linalg.qr(a)[0]
    yield "equal", q @ np.diag(np.repeat([5.0, 3.0, 3.0, 1.0], 10)) @ q.T
    yield "close", q @ np.diag(1 + 1e-9 * np.arange(40)) @ q.T
    yield "deficient", a[:, :3] @ a[:, :3].T
    yield "diagonal", np.diag(np.arange(40.0))
    yield "identity", np.eye(7)
    yield "zero", np.zeros((5, 5))
    yield "one", np.array([[2.0]])
    yield "tiny", 1e-200 * (a @ a.T)


@pytest.mark.parametrize("name, matrix", list(matrices()), ids=lambda v: v if isinstance(v, str) else "")
def test_components(name, matrix):
    k = min(32, len(matrix))
    values, vectors = whitening.leading_components(matrix, k)
    right = np.linalg.eigvalsh(matrix)[::-1][:k]
    size = max(np.abs(right).max(), 1e-300)
    assert np.abs(values - right).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * size


def test_tridiagonal_form_and_counts():
    rng = np.random.default_rng(5)
    a = rng.normal(size=(20, 20))
    a = a + a.T
    d, e, q = whitening.householder(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    assert np.abs(q @ t @ q.T - a).max() < 1e-12
    values = np.linalg.eigvalsh(a)
    at = np.concatenate((values - 1e-9, values + 1e-9))
    assert whitening.below(d, e, at).tolist() == [int((values < v).sum()) for v in at]


def check(rows, found, components=32):
    kept = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept], np.int64)
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    width = int((values[:components] > 1e-9 * values[0]).sum())
    assert len(found) == n * width
    white = y @ vectors[:, :width] / np.sqrt(values[:width])
    deviation = [sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums)) for v in x]
    theirs = {}
    for r in found:
        theirs.setdefault((r.vec_id, r.component), []).append(r)
    sign = {}
    for (key, _), w, d in zip(kept, white, deviation):
        for c in range(width):
            options = theirs[key, c + 1]
            r = min(options, key=lambda r: abs(abs(r.whitened) - abs(w[c])))
            assert r.n == n and d in [int(o.deviation) for o in options]
            assert abs(abs(r.whitened) - abs(w[c])) < 1e-6
            if abs(w[c]) > 0.1 and len(options) == 1:
                assert sign.setdefault(c, np.sign(w[c] * r.whitened)) == np.sign(w[c] * r.whitened)
            assert abs(r.explained - values[c] / np.trace(cov)) < 1e-4 * values[c] / np.trace(cov)
            assert r.identity_error < 1e-8


def test_given_embeddings(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = op12_embedding_whitening(spark, folder)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(rows, found.collect())


def test_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(50)]
    rows += [(60, None), (61, [1.0, None, 0.0, 0.0, 0.0]), (62, [math.nan] * 5), (63, [math.inf] * 5), (None, [0.5] * 5), (3, [0.25] * 5), (7, rows[7][1]), (64, [-0.0] * 5)]
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id long, embedding array<double>, component string, n int")
    check(rows, whitening.whiten(frame, 32).collect())
    assert len(whitening.whiten(frame, 2).collect()) == 2 * 54


def test_flat_and_empty(spark):
    shape = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], shape)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, shape)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], shape)).collect() == []
    # A constant dimension has no component; a length of its own is fitted by itself.
    found = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0]), (4, [3.0])], shape)).collect()
    assert sorted((r.vec_id, r.component, r.n, round(abs(r.whitened), 9), r.explained) for r in found) == [(k, 1, 2, 1.0, 1.0) for k in (1, 2, 3, 4)]
