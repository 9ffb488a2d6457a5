import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from monthmill.operators.slices import day_slice
from monthmill.streaming import jobs

SCHEMA = "id long, ts timestamp_ntz, file string, took double"
START = datetime.datetime(2022, 8, 28, 9, 0, 0)


def add_file(spark, folder, data):
    at = [(i, START + datetime.timedelta(seconds=s), f, t) for i, s, f, t in data]
    spark.createDataFrame(at, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_path, transform, **options):
    source = jobs.arriving_files(spark, str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema, "*.parquet", **options)
    stream = transform(source)
    jobs.run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    return spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))


def stats(source):
    return jobs.window_stats(source, "ts", ["file"], "took", "30 seconds", "1 minute")


def test_closed_windows_equal_the_batch_result(spark, tmp_path):
    data = [(i, i * 7, f"f{i % 3}", float(i)) for i in range(100)]
    add_file(spark, str(tmp_path / "in"), data)
    got = run(spark, tmp_path, stats)
    last = START + datetime.timedelta(seconds=99 * 7 - 60)
    batch = (
        spark.read.parquet(str(tmp_path / "in"))
        .groupBy(F.window(F.col("ts").cast("timestamp"), "30 seconds").alias("w"), "file")
        .agg(F.count("*"), F.sum("took"), F.max("took"))
        .where(F.col("w.end").cast("timestamp_ntz") <= F.lit(last))
        .withColumn("w", F.col("w.start").cast("timestamp_ntz"))
    )
    assert rows(got) == rows(batch) and got.count() > 50


def test_late_rows_are_dropped(spark, tmp_path):
    add_file(spark, str(tmp_path / "in"), [(1, 0, "f", 1.0), (2, 600, "f", 1.0)])
    assert run(spark, tmp_path, stats).count() == 1
    add_file(spark, str(tmp_path / "in"), [(3, 1, "f", 9.0), (4, 1200, "f", 1.0)])
    got = run(spark, tmp_path, stats)
    assert {(r.window_start, r.n, r.total) for r in got.collect()} == {
        (START, 1, 1.0),
        (START + datetime.timedelta(seconds=600), 1, 1.0),
    }


@pytest.mark.parametrize("files", [None, 1])
def test_a_second_run_takes_only_what_is_new(spark, tmp_path, files):
    def slice_(df):
        return day_slice(df, "2022-08-28", "ts", ["id"])

    add_file(spark, str(tmp_path / "in"), [(1, 0, "f", 1.0), (2, 86400, "f", 1.0)])
    add_file(spark, str(tmp_path / "in"), [(3, 5, "f", 1.0)])
    assert rows(run(spark, tmp_path, slice_, files_per_batch=files)) == [(1, "2022-08-28"), (3, "2022-08-28")]
    add_file(spark, str(tmp_path / "in"), [(4, 9, "f", 1.0)])
    got = run(spark, tmp_path, slice_, files_per_batch=files)
    assert rows(got) == [(i, "2022-08-28") for i in (1, 3, 4)]
    assert rows(got) == rows(slice_(spark.read.parquet(str(tmp_path / "in"))))


def test_files_out_of_time_order_lose_nothing(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "parts")
    schema = spark.createDataFrame([], SCHEMA).schema
    for day in (3, 1, 2, 4):
        add_file(spark, folder, [(day, day * 86400, "f", float(day)), (day, day * 86400 + 1, "g", None)])
        source = jobs.arriving_files(spark, folder, schema, "*.parquet")
        jobs.fold_available(source, "ts", ["file"], "took", out, str(tmp_path / "cp"))
    late = [(9, 86400 + 2, "f", 10.0)]
    add_file(spark, folder, late)
    jobs.fold_available(jobs.arriving_files(spark, folder, schema, "*.parquet"), "ts", ["file"], "took", out, str(tmp_path / "cp"))
    got = {(r.window_start, r.file): (r.n, r.total, r.largest) for r in jobs.folded(spark, out, {"file": "string"}).collect()}
    assert len(got) == 8
    assert got[START + datetime.timedelta(days=1), "f"] == (2, 11.0, 10.0)
    assert got[START + datetime.timedelta(days=4), "g"] == (1, None, None)


def test_parts_are_merged_and_nothing_counts_twice(spark, tmp_path, monkeypatch):
    """Many batches leave few folders; a merge that fails and a batch that runs again change nothing."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "parts")
    schema = spark.createDataFrame([], SCHEMA).schema
    given = []

    def step(batches):
        for _ in range(batches):
            i = len(given)
            given.append((i, (i * 37) % 11 * 30, "fg"[i % 2], float(i)))
            add_file(spark, folder, given[-1:])
        jobs.fold_available(jobs.arriving_files(spark, folder, schema, "*.parquet", 1), "ts", ["file"], "took", out, str(tmp_path / "cp"), slots=3)

    def check():
        expected = {}
        for _, at, file, took in given:
            key = START + datetime.timedelta(seconds=at), file
            n, total, largest = expected.get(key, (0, 0.0, 0.0))
            expected[key] = n + 1, total + took, max(largest, took)
        found = jobs.folded(spark, out, {"file": "string"}).collect()
        assert {(r.window_start, r.file): (r.n, r.total, r.largest) for r in found} == expected

    step(7)
    check()
    whole = jobs._merged

    def broken(*given):
        raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "_merged", broken)
    with pytest.raises(Exception):
        step(2)  # batch 8 fills the last slot and fails in the merge
    monkeypatch.setattr(jobs, "_merged", whole)
    check()
    step(4)
    check()
    assert len(list((tmp_path / "parts" / "parts").glob("slot=*"))) == 3
    assert len(list((tmp_path / "parts" / "generations").glob("slot=*"))) == 2
    # The last batch runs again after its merge.
    newest, upto = jobs._generation(spark, out)
    assert upto == 11 and newest in (0, 1)


def test_stream_assembles_records_as_a_batch_does(spark, tmp_path):
    from monthmill.sources.logfiles import log_records

    folder, out = tmp_path / "log", str(tmp_path / "parts")
    folder.mkdir()
    head = "[2022-08-28T09:00:0%d.000+0000] {processor.py:161} INFO - Processing /d/a.py took %s seconds"
    (folder / "a.log").write_text("\n".join([head % (1, "1.5"), "[2 a line that looks like a separator", head % (2, "2.5")]))
    (folder / "b.log").write_text("\n".join([head % (3, "3.0"), "  plain continuation"]))
    jobs.fold_available(jobs.arriving_logs(spark, str(folder)), "ts", ["source"], "took", out, str(tmp_path / "cp"), prepare=jobs.log_batch)
    got = [(r.n, r.total, r.largest) for r in jobs.folded(spark, out, {"source": "string"}).collect()]
    assert got == [(3, 7.0, 3.0)]
    records = sorted(r.record.count("\n") for r in log_records(spark, str(folder)).collect())
    assert records == [0, 1, 1]
