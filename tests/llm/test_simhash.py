"""Fingerprints and near duplicates against a brute-force version."""

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from monthmill.llm import simhash
from monthmill.llm.graph import components


def slow_fingerprint(text, shingle=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def slow_components(codes, bits=3):
    codes = sorted(set(codes))
    up = {c: c for c in codes}

    def find(c):
        while up[c] != c:
            c = up[c]
        return c

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= bits:
                up[find(a)] = find(b)
    return {c: find(c) for c in codes}


def expected(rows, bits=3):
    prints = [(key, slow_fingerprint(text)) for key, text in rows]
    group = slow_components([fp for _, fp in prints], bits)
    smallest = {}
    for key, fp in prints:
        if key is not None:
            smallest[group[fp]] = min(key, smallest.get(group[fp], key))
    return sorted(((key, f"{fp:016x}", smallest.get(group[fp])) for key, fp in prints), key=repr)


@pytest.mark.parametrize("text", ["", None, " \t", "One", "a b", "A b C", "ÀÉ x\x0by\x1cz é e", "x " * 500, "The same words the same words the same words"])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) % 2**64 == slow_fingerprint(text)


def test_near_duplicates_of_texts(spark):
    rng = random.Random(1)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(60):
        text = [rng.choice(words) for _ in range(rng.choice([1, 3, 40, 300]))]
        rows.append((k, " ".join(text)))
        for c in range(rng.choice([0, 0, 1, 3])):
            other = list(text)
            other[rng.randrange(len(other))] = "changed"
            rows.append((1000 + 10 * k + c, " ".join(other if rng.random() < 0.7 else text)))
    rows += [(7, "repeated key"), (7, "repeated key"), (None, "no key"), (None, None), (5000, None), (5001, ""), (5002, "long " * 20000)]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, fp string, `group` int")
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hexadecimal("fp"), "component_id")
    assert sorted(map(tuple, found.collect()), key=repr) == expected(rows)


def test_tree_finds_all_links(spark, monkeypatch):
    """Small shards, so that codes cross many borders; chains and a dense group."""
    monkeypatch.setattr(simhash, "SHARD", 64)
    monkeypatch.setattr(simhash, "DIRECT", 8)
    rng = random.Random(2)
    codes = [rng.getrandbits(64) for _ in range(1500)]
    for _ in range(1500):
        code = rng.choice(codes)
        for _ in range(rng.randint(1, 4)):
            code ^= 1 << rng.randrange(64)
        codes.append(code)
    codes += [codes[0] ^ 1 << a ^ 1 << b for a in range(20) for b in range(a)]
    signed = np.array(sorted(set(codes)), np.uint64).view(np.int64).tolist()
    found = components(simhash.near_links(spark.createDataFrame([(c,) for c in signed], "fp long").repartition(4))).collect()
    group = {r.node % 2**64: r.component % 2**64 for r in found}
    groups = slow_components(codes)
    mine, theirs = {}, {}
    for c in groups:
        mine.setdefault(group.get(c, c), set()).add(c)
        theirs.setdefault(groups[c], set()).add(c)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_equal_codes_and_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.without_near_duplicates(empty).collect() == []
    same = spark.createDataFrame([(k, "one text") for k in range(50)], "doc_id long, text string")
    assert {r.component_id for r in simhash.near_duplicates(same).collect()} == {0}


def test_one_of_each_group_stays(spark):
    rows = [(3, "a b c d", "x"), (2, "a b c d", "y"), (9, "other words here now", "z"), (9, "other words here now", "z"), (None, "a b c d", "n"), (5, None, None), (4, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[1], rows[2], rows[6]], key=repr)


def test_rows_are_decided_by_themselves(spark):
    """One key with two texts, keys that are null, a map beside, a column with the name of the row number."""
    a, b, c = "first text of four words", "quite another text this is", "and a third one here now"
    rows = [(1, a, {"k": 1}, 0), (1, b, {"k": 2}, 0), (2, c, {}, 0), (3, a, None, 0), (None, c, {"k": 3}, 0), (None, "a text without a key", None, 0), (None, "a text without a key", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>, _row int")
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[1], rows[2], rows[5]], key=repr)
