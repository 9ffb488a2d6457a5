import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from monthmill.operators import logs
from monthmill.sources import logfiles

SAMPLE = """\
[2022-08-28T15:36:39.911+0600] {processor.py:153} INFO - Started process (PID=1) to work on /d/a.py
[2022-08-28T15:36:39.920+0600] {logging_mixin.py:115} INFO - [2022-08-28T15:36:39.917+0600] {dagbag.py:321} ERROR - Failed to import: /d/a.py
Traceback (most recent call last):
SyntaxError: invalid syntax
[2022-08-28T15:36:39.921+0600] {processor.py:652} WARNING - No viable dags retrieved from /d/a.py
[2022-08-28T15:36:40.000+0600] {processor.py:650} INFO - DAG(s) dict_keys(['x', 'x.s1', 'x.s2']) retrieved from /d/b.py
[2022-08-28T15:36:39.954+0600] {processor.py:161} INFO - Processing /d/a.py took 0.049 seconds
"""


@pytest.fixture(scope="module")
def sample(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("logs")
    (path / "sub").mkdir()
    (path / "sub" / "a.log").write_text(SAMPLE)
    return logs.measured(logs.log_fields(logfiles.log_records(spark, str(path)))).cache()


def test_records_and_fields(sample):
    got = sample.orderBy("lineno").collect()
    assert [(r.module, r.lineno, r.level) for r in got] == [
        ("processor.py", 153, "INFO"),
        ("processor.py", 161, "INFO"),
        ("dagbag.py", 321, "ERROR"),
        ("processor.py", 650, "INFO"),
        ("processor.py", 652, "WARNING"),
    ]
    error = got[2]
    assert error.ts == datetime.datetime(2022, 8, 28, 9, 36, 39, 917000)
    assert error.message == "Failed to import: /d/a.py"
    assert error.continuation == "Traceback (most recent call last):\nSyntaxError: invalid syntax"
    assert got[3].n_pipelines == 3 and got[1].took == 0.049
    assert {r.source for r in got} == {"/d/a.py", "/d/b.py"}


def test_stats_per_file(sample):
    stats = {r.source: r for r in logs.file_stats(sample).collect()}
    a, b = stats["/d/a.py"], stats["/d/b.py"]
    assert (a.n_records, a.n_errors, a.n_warnings, a.n_failed_imports, a.n_continued) == (4, 1, 1, 1, 1)
    assert (a.n_pipelines, a.n_runs, a.median_took) == (0, 1, 0.049)
    assert (b.n_pipelines, b.n_runs, b.mean_took) == (3, 0, None)
    assert [r.source for r in logs.in_listing_order(logs.file_stats(sample)).collect()] == ["/d/a.py", "/d/b.py"]
    assert rows(logs.level_counts(sample, "source"))[0] == ("/d/a.py", "ERROR", 1)


def test_median_counts_each_run(spark):
    data = [("f", "INFO", "m", None, None, t) for t in [0.1, 0.1, 0.1, 0.4]] + [("f", "INFO", "m", None, None, None)]
    df = spark.createDataFrame(data, "source string, level string, message string, continuation string, n_pipelines int, took double")
    row = logs.file_stats(df).first()
    assert (row.n_records, row.n_runs, row.median_took, row.max_took) == (5, 4, 0.1, 0.4)
    assert row.mean_took == pytest.approx(0.175)


def test_latest_run(spark):
    at = datetime.datetime(2022, 1, 1)
    data = [("f", at, 0.2), ("f", at + datetime.timedelta(seconds=1), 0.1), ("f", at + datetime.timedelta(seconds=2), None)]
    df = spark.createDataFrame(data, "source string, ts timestamp_ntz, took double")
    assert rows(logs.latest_runs(df)) == [("f", at + datetime.timedelta(seconds=1), 0.1)]


def test_lines(spark, tmp_path):
    (tmp_path / "a.log").write_text(SAMPLE)
    assert logfiles.log_lines(spark, str(tmp_path)).count() == 7


def by_hand(text):
    """Records of one file: a line that starts with a time opens a record."""
    found = []
    for line in text.rstrip("\n").split("\n"):
        if re.match(r"\[2\d{3}-\d\d-\d\dT\d\d:\d\d:\d\d", line) or not found:
            found.append(line)
        else:
            found[-1] += "\n" + line
    return sorted(found)


@pytest.mark.parametrize("stray", [[], ["[2, 3]", "[2[x", "[20 of 30]", "  [2022-"]])
@pytest.mark.parametrize("block", ["64", "128m"])
def test_records_against_reading_line_by_line(spark, tmp_path, stray, block):
    """Small blocks cut the files at any place, also inside records."""
    pick = random.Random(len(stray))
    texts = []
    for f in range(3):
        lines = []
        for i in range(150):
            lines.append(f"[2022-08-28T15:36:{i % 60:02d}.{i:03d}+0600] {{m.py:{i}}} INFO - message {i}")
            lines += pick.choices(["plain", "[1] one", *stray], k=pick.randrange(3))
        texts.append("\n".join(lines) + "\n")
        (tmp_path / f"{f}.log").write_text(texts[-1])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = logfiles.log_records(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r.record for r in got) == sorted(sum((by_hand(t) for t in texts), []))
    assert len({r.file for r in got}) == 3


def test_strays_of_a_large_file_are_joined_in_chunks(spark, tmp_path):
    lines = []
    for i in range(300):
        lines.append(f"[2022-08-28T15:36:39.{i:03d}+0600] {{m.py:{i}}} INFO - message")
        lines += ["[2] a", "[2] b"] if i % 7 == 0 else []
    text = "\n".join(lines) + "\n"
    (tmp_path / "a.log").write_text(text)
    pieces = logfiles.durable(logfiles.log_pieces(spark, str(tmp_path)))
    got = logfiles.joined_pieces(pieces, hot_rows=40).collect()
    assert sorted(r.record for r in got) == by_hand(text)


def test_text_before_the_first_record_stays(spark, tmp_path):
    text = "a preface\n[2] more\n[2022-08-28T15:36:39.000+0600] {m.py:1} INFO - x\n[2] tail\n"
    (tmp_path / "a.log").write_text(text)
    got = sorted(r.record for r in logfiles.log_records(spark, str(tmp_path)).collect())
    assert got == ["[2022-08-28T15:36:39.000+0600] {m.py:1} INFO - x\n[2] tail", "[2] more", "a preface"]


def test_a_line_that_is_no_record_keeps_its_text(spark):
    df = spark.createDataFrame([("hello\nworld",)], "record string")
    row = logs.log_fields(df).first()
    assert (row.message, row.continuation, row.level, row.ts) == ("hello", "world", None, None)


def test_runs_from_starts_and_ends(spark):
    at = lambda s: datetime.datetime(2022, 1, 1, 0, 0, s)
    start = lambda pid: f"Started process (PID={pid}) to work on /d/f.py"
    data = [
        ("f", at(0), "Processing /d/f.py took 0.1 seconds", 0.1),
        ("f", at(1), start(7), None),
        ("f", at(2), "Processing file /d/f.py for tasks to queue", None),
        ("f", at(3), "Processing /d/f.py took 2 seconds", 2.0),
        ("f", at(4), start(8), None),
        ("f", at(5), start(9), None),
        ("f", at(5), "Processing /d/f.py took 0 seconds", 0.0),
        ("f", at(6), start(10), None),
        ("g", at(1), start(11), None),
    ]
    df = spark.createDataFrame(data, "source string, ts timestamp_ntz, message string, took double")
    expected = [
        ("f", None, None, at(0), 0.1, "unstarted"),
        ("f", 7, at(1), at(3), 2.0, "finished"),
        ("f", 8, at(4), None, None, "open"),
        ("f", 9, at(5), at(5), 0.0, "finished"),
        ("f", 10, at(6), None, None, "open"),
        ("g", 11, at(1), None, None, "open"),
    ]
    for hot in (1_000_000, 3):
        assert rows(logs.run_spans(df, hot_rows=hot)) == sorted(expected, key=repr)
    assert logs.run_spans(df.limit(0)).collect() == []
