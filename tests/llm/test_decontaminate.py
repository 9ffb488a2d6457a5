"""Phrases and proximity against a brute-force version."""

import random
import re

from monthmill.llm import decontaminate
from monthmill.llm.decontaminate import contamination, proximity, without_contaminated


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def slow(docs, items, length=10):
    out = []
    for key, text in docs:
        w, hit, ids = words(text), set(), set()
        for item, other in items:
            b = words(other)
            n = min(length, len(b))
            for i in range(len(b) - n + 1) if n else ():
                for at in range(len(w) - n + 1):
                    if w[at : at + n] == b[i : i + n]:
                        hit |= set(range(at, at + n))
                        ids.add("null" if item is None else str(item))
        out.append((key, len(w), len(hit), sorted(ids)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return spark.createDataFrame([(*r, "t", 5) for r in docs], "doc_id long, text string, term string, row int"), spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, n int")


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)] + ["É", "été", "the"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.choice([3, 9, 10, 14, 40]))) for k in range(12)] + [(100, ""), (101, None), (None, say(12)), (3, say(11)), (102, "unheard of words here"), (103, "w1")]
    docs = []
    for k in range(60):
        text = say(rng.choice([0, 5, 60, 200]))
        for _ in range(rng.randint(0, 3)):
            item = words(rng.choice(items)[1])
            text += rng.choice([" ", ", ", "--\n"]) + " ".join(item[rng.randint(0, 3) : len(item) - rng.randint(0, 3)]).upper()
            text += " " + say(3)
        docs.append((k, rng.choice(["", "... ", "(a"]) + text + rng.choice(["", ".", " \n"])))
    docs += [(500, None), (501, ""), (502, "..."), (503, "."), (504, "w1"), (7, docs[3][1]), (None, docs[4][1]), (505, (items[3][1] + " x ") * 200)]
    return docs, items


def test_contamination(spark, monkeypatch):
    for seed, block in ((1, 200_000), (2, 60)):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
        docs, items = case(seed)
        found = contamination(*frames(spark, docs, items)).select("doc_id", "n_words", "n_hit", "items").collect()
        assert sorted(map(tuple, found), key=repr) == slow(docs, items)


def test_clean_documents_stay(spark):
    docs, items = case(3)
    kept = without_contaminated(*frames(spark, docs, items))
    assert kept.columns == ["doc_id", "text", "term", "row"]
    clean = [(k, t) for k, t in docs if not slow([(k, t)], items)[0][2]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_rows_are_decided_by_themselves(spark, monkeypatch):
    """A contaminated row takes no other row of its key with it, and goes without a key, in one block of items and in several."""
    bad = "one two three four five six seven eight nine ten"
    rows = [(1, "clean words", {"k": 1}), (1, f"x {bad} y", {"k": 2}), (None, bad, None), (None, "clean words", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string,int>")
    items = spark.createDataFrame([(1, bad), (2, "other words that stand nowhere at all in these texts here")], "item_id long, text string")
    for words in (200_000, 5):
        monkeypatch.setattr(decontaminate, "BLOCK_WORDS", words)
        kept = without_contaminated(docs, items)
        assert sorted(map(tuple, kept.collect()), key=repr) == sorted([rows[0], rows[3]], key=repr)


def test_proximity(spark):
    docs = [(1, "alpha x beta gamma delta"), (2, "alpha beta gamma"), (3, "alpha y z q beta gamma"), (4, "gamma beta alpha"), (5, "beta gamma alpha alpha beta gamma")]
    items = [(9, "alpha beta gamma")]
    exact = proximity(*frames(spark, docs, items), slop=0)
    assert sorted((r.doc_id, r["at"]) for r in exact.collect()) == [(2, 0), (5, 3)]
    loose = proximity(*frames(spark, docs, items), slop=1)
    assert {r.doc_id for r in loose.collect()} >= {1, 2, 5} and 3 not in {r.doc_id for r in loose.collect()}


def test_empty_tables(spark):
    docs, items = frames(spark, [(1, "a b"), (2, None)], [(1, "a b")])
    assert contamination(docs.limit(0), items).collect() == []
    assert sorted(tuple(r)[1:] for r in contamination(docs, items.limit(0)).collect()) == [(1, 2, 0, []), (2, 0, 0, [])]
