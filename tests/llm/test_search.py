"""Ranked search against a brute-force version."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from monthmill.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), t) for t in TERM.findall(text or "")]


def slow(docs, items, k=10):
    held = [(key, terms(text)) for key, text in docs]
    some, length = sum(bool(t) for _, t in held), sum(len(t) for _, t in held)
    out = []
    for item, text in items:
        wanted = set(terms(text))
        weight = {t: math.floor(1000 * math.log((2.0 * some + 2) / (2.0 * sum(t in h for _, h in held) + 1))) for t in wanted}
        scores = []
        for key, words in held:
            if words:
                m = 10 + (90 * len(words) * some) // length
                scores.append((sum(weight[t] * ((10**9 * words.count(t)) // (1000 * words.count(t) + 8 * m)) for t in wanted), key))
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k]
        out += [(item, rank, key, score) for rank, (score, key) in enumerate(best, 1)]
    return sorted(out, key=repr)


def made(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a1", "Éa", "naïve", "中文", "x" * 300] + [f"w{i}" for i in range(60)]
    text = lambda top: rng.choice([" ", "-", "\n"]).join(rng.choices(words, [80 / (i + 1) for i in range(len(words))], k=rng.randint(1, top)))
    docs = [(rng.randrange(n), text(40)) for _ in range(n)] + [(None, "w3 w9 the"), (7, None), (8, ""), (9, "?! .")]
    docs += [(1000 + i, "w50 w51 w52 the") for i in range(30)] + [(5, "of " * 3000 + "w59")]
    rng.shuffle(docs)
    items = [(i, text(12)) for i in range(25)] + [(3, "w50 w51"), (None, "w9 w9 W9"), (40, None), (41, "..."), (42, "unheard"), (43, "w52 w59 of")]
    return docs, items


@pytest.mark.parametrize("shard, block", [(8192, 4 << 20), (16, 3000)])
def test_search(spark, monkeypatch, shard, block):
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "BLOCK_BYTES", block)
    docs, items = made(shard, 400)
    # Columns that clash with names of the operator change nothing.
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, text string, item string, score int, rank int").repartition(3)
    found = search.search(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == slow(docs, items)
    assert sorted((tuple(r) for r in search.search(frame, spark.createDataFrame(items, "item_id long, text string"), k=3).collect()), key=repr) == slow(docs, items, 3)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(docs.limit(0), items).collect() == []
    assert search.search(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("splits, pool", [(16, 1 << 22), (2, 5)])
def test_branches_are_cut(monkeypatch, splits, pool):
    """Far fewer documents are scored than hold a term."""
    monkeypatch.setattr(search, "SPLITS", splits)
    monkeypatch.setattr(search, "POOL", pool)
    rng = np.random.default_rng(2)
    n = 8000
    common, rare = np.arange(n), np.sort(rng.choice(n, 30, replace=False))
    places = np.concatenate((common, n + common, 2 * n + rare))
    impacts = np.concatenate((rng.integers(100, 200, 2 * n), np.full(30, 5000)))
    best = search.Best(1, 10)
    scored = search.search_shard(places, impacts, common, np.zeros(n, np.int8), np.array([0, 3]), np.arange(3), best)
    total = np.bincount(places % n, impacts, n).astype(int)
    assert scored < 200
    assert best.score[0].tolist() == sorted(total.tolist(), reverse=True)[:10]


def test_range_maxima():
    rng = np.random.default_rng(3)
    impacts = rng.integers(0, 9, 100)
    maxima = search.RangeMaxima(impacts, 100)
    pairs = np.array([(a, b) for a in range(100) for b in range(a + 1, 101)])
    assert maxima.places(pairs[:, 0], pairs[:, 1]).tolist() == [a + int(np.argmax(impacts[a:b])) for a, b in pairs]


def test_postings_in_windows(monkeypatch):
    texts = ["Ab ab é-é", None, "", "abab" * 20, "ab", "AB,cd"]
    monkeypatch.setattr(search, "WINDOW", 5)
    n, pairs, times = search.postings(pa.array(texts), pa.array([b"ab", "é".encode()], pa.large_binary()))
    assert n.tolist() == [4, 0, 0, 1, 1, 2]
    assert pairs.tolist() == [0, 1, 8, 10] and times.tolist() == [2, 2, 1, 1]
