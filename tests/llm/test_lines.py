"""Repeated lines against a brute-force version."""

import random
from collections import defaultdict

import pytest

from monthmill.llm import lines

BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def slow(rows, least=40, documents=5):
    holders = defaultdict(set)
    for key, text in rows:
        for line in (text or "").split("\n"):
            holders[ascii_lower(line.strip(BLANKS))].add(key)
    lost = {k: max((d for d in docs if d is not None), default=None) for k, docs in holders.items() if len(k) >= least and len(docs) >= documents}
    out = []
    for key, text in rows:
        all_lines = (text or "").split("\n")
        kept = [line for line in all_lines if lost.get(k := ascii_lower(line.strip(BLANKS)), key) == key or k not in lost]
        out.append((key, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def found(spark, rows):
    docs = spark.createDataFrame([(k, 7, t, "x") for k, t in rows], "doc_id long, n_lines int, text string, line string")
    result = lines.drop_repeated_lines(docs)
    assert result.columns == ["doc_id", "text", "line", "n_lines", "n_dropped"]
    return sorted(((r.doc_id, r.text or "", r.n_lines, r.n_dropped) for r in result.collect()), key=repr)


@pytest.mark.parametrize("shard, round_bytes, most_rounds", [(500_000, 32 << 20, 8), (10, 8, 1000), (10, 8, 0)])
def test_repeated_lines(spark, monkeypatch, shard, round_bytes, most_rounds):
    monkeypatch.setattr(lines, "MOST_ROUNDS", most_rounds)
    monkeypatch.setattr(lines, "MEETING", 3)
    monkeypatch.setattr(lines, "SHARD", shard)
    monkeypatch.setattr(lines, "ROUND_BYTES", round_bytes)
    rng = random.Random(4)
    common = [f"Line {k} that Many documents share, É and so ON {'x' * (k % 3)}" for k in range(30)] + ["é" * 39, "é" * 40, "short line", "a" * 40, "a" * 39]
    rows = []
    for k in range(120):
        text = [rng.choice(common) for _ in range(rng.randint(0, 6))] + [f"own line {k} {rng.random()} with enough characters to count as long"] * rng.randint(1, 2)
        text = [rng.choice(["", "  ", "\t"]) + (line.upper() if rng.random() < 0.2 else line) + rng.choice(["", "\r", "\x0b "]) for line in text]
        rng.shuffle(text)
        rows.append((k, "\n".join(text)))
    rows += [(None, common[0]), (None, common[1]), (500, None), (501, ""), (502, "\n\n"), (503, "\n".join([common[2]] * 3000)), (7, common[3]), (7, common[3])]
    assert found(spark, rows) == slow(rows)


def test_a_line_of_all_documents_and_empty_table(spark):
    rows = [(k, "The same line in every one of these documents, word by word\nrest") for k in range(300)]
    assert found(spark, rows) == slow(rows)
    assert found(spark, rows[:4]) == slow(rows[:4])
    assert lines.drop_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
