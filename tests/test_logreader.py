import io
import os
import random

import pytest

from conftest import plan
from monthmill.operators.logs import log_fields
from monthmill.sources import logfiles, logreader
from monthmill.streaming import jobs
from test_logs import by_hand

HEAD = "[2022-08-28T15:36:%02d.000+0600] {m.py:%d} INFO - "


def made(seed, records=60):
    pick = random.Random(seed)
    lines = pick.choices(["preface", "[2] x", ""], k=pick.randrange(3))
    for i in range(records):
        lines.append(HEAD % (i % 60, i) + "é" * pick.randrange(20))
        lines += pick.choices(["plain", "[2, 3]", "[2022-08-28T", "  " + HEAD % (1, 1), "x" * 50], k=pick.randrange(3))
    return "\n".join(lines) + pick.choice(["\n", ""])


@pytest.mark.parametrize("block", [1, 7, 21, 64, 1 << 20])
def test_splits_at_any_place(monkeypatch, block):
    """Whatever the ranges, every record comes once, from the range of its first byte."""
    monkeypatch.setattr(logreader, "BLOCK", block)
    for seed in range(6):
        data = made(seed, 12).encode()
        whole = list(logreader.records(io.BytesIO(data), 0, len(data)))
        assert all(data[at : at + len(r)] == r for at, r in whole)
        for split in (1, 5, 22, 33, 100, 1000):
            parts = [list(logreader.records(io.BytesIO(data), s, min(s + split, len(data)))) for s in range(0, len(data), split)]
            assert sum(parts, []) == whole
            assert all(s * split <= at < (s + 1) * split for s, part in enumerate(parts) if s for at, _ in part)


def test_against_reading_line_by_line(spark, tmp_path):
    texts = [made(s) for s in range(4)]
    os.mkdir(tmp_path / "sub")
    for i, text in enumerate(texts):
        (tmp_path / ("sub" if i % 2 else "") / f"{i}.log").write_text(text)
    (tmp_path / "_hidden").write_text("x")
    (tmp_path / "empty").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150b")
    try:
        found = logreader.log_records(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 20
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = []
    for text in texts:
        lines = text.split("\n")
        first = next(i for i, line in enumerate(lines) if line.startswith("[2022-08-28T15"))
        expected += [line for line in lines[:first] if line] + by_hand("\n".join(lines[first:]))
    assert sorted(r.record for r in found.collect()) == sorted(expected)


def test_one_read_and_no_shuffle(spark, tmp_path):
    (tmp_path / "a.log").write_text(made(1))
    text = plan(log_fields(logfiles.log_records(spark, f"file://{tmp_path}")))
    assert text.count("Scan") == 1 and "Exchange" not in text
    with pytest.raises(Exception, match="no-such-folder"):
        logreader.log_records(spark, str(tmp_path / "no-such-folder")).collect()
    assert not logreader.can_open("viewfs://cluster/logs") and logreader.can_open("/logs") and logreader.can_open("s3a://logs")


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def add(name, seconds, modified):
        (folder / name).write_text("".join(HEAD % (s, s) + "Processing /d/a.py took 1.5 seconds\nmore\n" for s in seconds))
        os.utime(folder / name, (modified, modified))

    def run():
        jobs.fold_available(logreader.arriving_records(spark, str(folder), grace=100), "ts", ["source"], "took", out, state, prepare=jobs.record_batch)
        return sum(r.n for r in jobs.folded(spark, out, {"source": "string"}).collect())

    add("a", [1, 2], 1000)
    assert run() == 2
    assert run() == 2
    add("b", [3], 1000)  # the same time of modification
    add("c", [4, 5, 6], 950)  # older, within the grace
    assert run() == 6
    add("d", [7], 5000)
    assert run() == 7
