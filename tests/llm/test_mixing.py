"""Targets and the mix against a brute-force version."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from monthmill.llm import mixing


def slow_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(w for s, w in weight.items() if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / total for s in order}
        above = {s for s in order if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, target int")


def test_targets_and_taken_words(spark, monkeypatch):
    monkeypatch.setattr(mixing, "INTERVAL", 7)
    rng = random.Random(3)
    rows = [(k, " ".join("w" * rng.randint(0, 60)), rng.choice(["a", "a", "b", "c", "é", None])) for k in range(400)]
    rows += [(1000, None, "a"), (1001, "", None), (None, "no key", "b"), (5, "again", "c"), (5, "again", "c"), (1002, "x " * 3000, "d"), (1003, None, "empty")]
    found = mixing.mix(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets, taken, longest = slow_targets(sizes), defaultdict(int), defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r["size"])
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= longest[source]
    assert {s for s in sizes if targets[s] == 2 * sizes[s]} and {s for s in sizes if targets[s] < sizes[s]}


def test_reruns_and_rows_of_the_mix_agree(spark):
    rows = [(k, " ".join("w" * (k % 9)), "abc"[k % 3]) for k in range(60)] + [(3, " ".join("w" * 3), "a")]
    docs = frame(spark, rows)
    one, two = (sorted(map(tuple, mixing.mix(docs.repartition(n)).collect())) for n in (1, 5))
    assert one == two
    full = mixing.mixed(docs)
    assert full.columns == [*docs.columns, "epoch"]
    assert full.count() == sum(r.copies for r in mixing.mix(docs).collect())
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert {r.doc_id: r.n for r in full.groupBy("doc_id").agg(F.count_distinct("epoch").alias("n")).collect()} == {k: n for k, n in taken.items() if n}


def test_mix_with_null_sources_and_words_of_none(spark):
    rows = [(k, "w " * (k % 4), [None, "a", "b", "empty"][k % 4]) for k in range(80)]
    docs = frame(spark, rows)
    taken = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    assert {r.doc_id: r["count"] for r in mixing.mixed(docs).groupBy("doc_id").count().collect()} == {k: n for k, n in taken.items() if n}


def test_repeated_rows_are_cut_one_by_one(spark):
    """The mix takes the words that ``mix`` says, also of rows that share key and text; no row comes more often than allowed."""
    rows = [(None, "w " * 20, "b")] * 100 + [(k, "w " * 30, "a") for k in range(100)] + [(None, "", "c")] * 17 + [(k, "v v v", "c") for k in range(5)]
    docs = spark.createDataFrame([(*r, {"k": 1}, 5) for r in rows], "doc_id long, text string, source string, m map<string,int>, _row int").repartition(4)
    taken, words = defaultdict(int), defaultdict(int)
    targets = {}
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
        targets[r.source] = r.target
    found = mixing.mixed(docs).collect()
    for r in found:
        words[r.source] += len(r.text.split())
    assert {s: words[s] for s in taken} == dict(taken)
    assert all(abs(words[s] - targets[s]) <= 15 for s in targets) and max(r.epoch for r in found) <= 2


def test_empty_tables(spark):
    assert mixing.mix(frame(spark, [(1, "a", "s")]).limit(0)).collect() == []
    assert [r.taken for r in mixing.mix(frame(spark, [(1, None, None)])).collect()] == [0]
    assert mixing.mixed(frame(spark, [(1, "a", "s")]).limit(0)).collect() == []
