import datetime
import json
import os
import random

from pyspark.sql import functions as F

from monthmill.operators.features import PERIODS
from monthmill.plans import cycle
from monthmill.sources.tables import csv_table, document_source

MONTH = datetime.date(2022, 7, 1)


def test_daily_export(spark, tmp_path):
    users = spark.createDataFrame(
        [(1, "a@x", "1", True, "t", "2022-09-18 01:02:03"), (2, "b@x", "2", None, "t", "2022-09-19 00:00:00")],
        "id long, email string, phone string, isKycApproved boolean, userType string, createdAt string",
    )
    path = cycle.export_day(users, "2022-09-18", str(tmp_path))
    out = csv_table(spark, path, "id long, email string, phone string, isKycApproved boolean, userType string, date string")
    assert [tuple(r) for r in out.collect()] == [(1, "a@x", "1", True, "t", "2022-09-18")]


def test_total_document(spark):
    golden = document_source(spark, '{"1001": 301.27, "1002": 433.21, "1003": 502.22}')
    assert round(json.loads(cycle.total_document(golden).first()[0])["total_order_value"], 6) == 1236.7
    both = document_source(spark, '{"a": 1}', "{}", '{"b": 2.5}')
    assert json.loads(cycle.total_document(both).first()[0]) == {"total_order_value": 3.5}


def test_monthly_cycle(spark, tmp_path):
    pick = random.Random(3)
    start = datetime.datetime(2022, 1, 1)
    data = [
        (i, pick.randrange(60), start + datetime.timedelta(hours=pick.randrange(212 * 24)), pick.choice("AB"))
        for i in range(500)
    ]
    requests = spark.createDataFrame(data, "id long, user long, ts timestamp_ntz, carrier string")
    # TH has users without any request, so it cannot be trained; MM and others have no training.
    codes = F.array(*[F.lit(m) for m in ("MY", "BD", "MM", "LK")])
    users = spark.range(60).select(F.col("id").alias("user"), F.get(codes, F.col("id") % 4).alias("market"))
    users = users.union(spark.createDataFrame([(99, "TH")], "user long, market string"))
    args = (requests, users, "user", ["ts", "id"], "carrier", MONTH, str(tmp_path))
    scored = cycle.monthly_cycle(*args, rounds=1)
    seen = {u for _, u, at, _ in data if at < datetime.datetime(2022, 7, 1)}
    got = scored.collect()
    assert sorted(r.user for r in got) == sorted(seen)
    assert {r.market for r in got} == {"MY", "BD", "MM", "LK"} and {r.data_month for r in got} == {"202207"}
    assert all(r.prediction in (0.0, 1.0) and 0.5 <= r.score <= 1 for r in got)
    assert f"num_days_p_{PERIODS - 1}" in scored.columns
    later = {u for _, u, at, _ in data if at >= datetime.datetime(2022, 7, 1) and at.month == 7}
    assert all(r.is_churn == (r.user not in later) for r in got)
    trained = set(os.listdir(tmp_path / "model"))
    assert trained <= {"MY", "BD"} and trained
    again = cycle.monthly_cycle(*args, rounds=1)
    assert again.count() == len(got)
    fewer = cycle.monthly_cycle(requests, users.where("market <> 'LK'"), *args[2:], rounds=1)
    without = {r.user for r in got if r.market == "LK"}
    assert {r.user for r in fewer.where("market IS NULL").collect()} == without and fewer.count() == len(got)
    assert fewer.where("market = 'LK'").isEmpty()
