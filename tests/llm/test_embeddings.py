"""Links of vectors against a brute-force version."""

import math

import numpy as np
import pytest

from monthmill.llm import embeddings


def slow(rows, least=0.95):
    ok = [k for k, (_, v) in enumerate(rows) if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    up = list(range(len(rows)))
    links = [0] * len(rows)

    def find(k):
        while up[k] != k:
            k = up[k]
        return k

    unit = {k: np.array(rows[k][1], float) / np.abs(rows[k][1]).max() for k in ok}
    unit = {k: u / np.linalg.norm(u) for k, u in unit.items()}
    for i, a in enumerate(ok):
        for b in ok[:i]:
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least:
                links[a] += 1
                links[b] += 1
                up[find(a)] = find(b)
    smallest = {}
    for k, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(k)] = min(key, smallest.get(find(k), key))
    return sorted(((key, links[k], smallest.get(find(k)), key == smallest.get(find(k))) for k, (key, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("block, visits, direct", [(4096, 8, 512), (64, 2, 8)])
def test_links(spark, monkeypatch, block, visits, direct):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "VISITS", visits)
    monkeypatch.setattr(embeddings, "DIRECT", direct)
    rng = np.random.default_rng(5)
    vectors = list(rng.normal(size=(250, 24)) * 10.0 ** rng.integers(-3, 4, (250, 1)))
    vectors += [v + rng.normal(size=24) * np.linalg.norm(v) * s for v, s in zip(vectors[:120], np.linspace(0.005, 0.09, 120))]
    vectors += [vectors[0]] * 40 + [vectors[1] * 2] * 3 + [vectors[2] + rng.normal(size=24) * 1e-3 * np.linalg.norm(vectors[2]) for _ in range(60)]
    rows = [(int(k), [float(x) for x in v]) for k, v in zip(rng.permutation(len(vectors)) + 100, vectors)]
    rows += [(1, None), (2, []), (3, [0.0] * 24), (4, [1.0, None] + [0.0] * 22), (5, [float("nan")] * 24), (6, [float("inf")] + [0.0] * 23), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0]), (10, [1e300] * 24), (11, [1e-300] * 24), (None, rows[5][1]), (None, None), (12, [3.0])]
    rows += [rows[7]]
    table = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<double>, n_links int, id string")
    assert sorted(map(tuple, embeddings.near_duplicates(table).collect()), key=repr) == slow(rows)


def test_links_with_few_intervals(spark, monkeypatch):
    """Beyond MOST_BLOCKS intervals grow; each meets those within reach only."""
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    monkeypatch.setattr(embeddings, "MOST_BLOCKS", 5)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(12, 6))
    rows = [(k, [float(x) for x in centres[k % 12] + rng.normal(size=6) * 0.1]) for k in range(240)] + [(900 + k, [float(x) for x in rng.normal(size=3)]) for k in range(30)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, embeddings.near_duplicates(table).collect()), key=repr) == slow(rows)


def test_empty_table(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(table).collect() == []
    one = spark.createDataFrame([(3, [1.0, 0.5])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in embeddings.near_duplicates(one).collect()] == [(3, 0, 3, True)]
