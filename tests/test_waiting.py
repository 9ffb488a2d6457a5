import datetime
import random


from conftest import plan, rows
from monthmill.operators import sketches
from monthmill.plans import monthly
from monthmill.streaming import deadlines, jobs

START = datetime.datetime(2022, 1, 1)


def test_missing_partitions_are_reported_and_taken_back(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    shape = "partition string, kind string, at timestamp, due timestamp"
    at = lambda minutes: START + datetime.timedelta(minutes=minutes)

    def run(*notes):
        spark.createDataFrame([(p, k, at(t), None if d is None else at(d)) for p, k, t, d in notes], shape).coalesce(1).write.mode("append").parquet(folder)
        stream = jobs.arriving_files(spark, folder, spark.createDataFrame([], shape).schema)
        jobs.run_available(deadlines.missing_after_deadline(stream), out, str(tmp_path / "state"))
        reports = spark.read.schema(deadlines.REPORT).parquet(out)
        return [r[:2] for r in rows(reports)], sorted(r.partition for r in deadlines.still_missing(reports).collect())

    # a comes in time, b never, c late, d before it is expected.
    said, missing = run(("a", "expected", 0, 60), ("b", "expected", 0, 60), ("c", "expected", 0, 90), ("d", "arrived", 1, None), ("a", "arrived", 30, None))
    assert said == [] and missing == []
    said, missing = run(("d", "expected", 70, 75))
    said, missing = run(("e", "expected", 71, 500))
    assert said == [("b", "missing")] and missing == ["b"]
    run(("f", "expected", 100, 700))
    said, missing = run(("f", "arrived", 101, None))
    assert said == [("b", "missing"), ("c", "missing")] and missing == ["b", "c"]
    said, missing = run(("c", "arrived", 102, None), ("g", "expected", 103, 50))
    assert ("c", "withdrawn") in said and ("g", "missing") in said and missing == ["b", "g"]
    said, missing = run(("c", "arrived", 104, None), ("b", "expected", 104, 60))
    assert len(said) == 4 and missing == ["b", "g"]


def test_sketches_keep_their_bound_when_merged(spark):
    rng = random.Random(4)
    values = [rng.lognormvariate(0, 2) for _ in range(30_000)]
    data = [("f" if i % 3 else "g", START + datetime.timedelta(days=i % 40), v) for i, v in enumerate(values)] + [("f", START, None)]
    stored = sketches.duration_sketches(spark.createDataFrame(data, "source string, ts timestamp, took double").repartition(6)).cache()
    assert stored.count() == 80
    for keys in (["source"], []):
        for row in sketches.merged_sketches(stored, keys).select(*keys, "n", "smallest", "largest", *[sketches.quantile(q).alias(f"q{q}") for q in (0.1, 0.5, 0.95)]).collect():
            mine = sorted(v for s, _, v in data if v is not None and (not keys or s == row.source))
            assert (row.n, row.smallest, row.largest) == (len(mine), mine[0], mine[-1])
            for q in (0.1, 0.5, 0.95):
                rank = sum(v <= row[f"q{q}"] for v in mine) / len(mine)
                assert abs(rank - q) < sketches.RANK_ERROR


def test_buckets_are_joined_where_they_lie(spark, folder):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = monthly.bucketed_feature_label(spark, folder)
        text = plan(joined)
        assert "Exchange" not in text and "SortMergeJoin" in text
        assert rows(joined) == rows(monthly.feature_label(spark, folder))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
