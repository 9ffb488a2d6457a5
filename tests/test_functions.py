import datetime
import json
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from monthmill.functions import dates, documents, names
from monthmill.operators.features import month_shift
from monthmill.sources.tables import document_source


def month_back(year, month, n):
    """Brute force: one month at a time."""
    for _ in range(n):
        year, month = (year, month - 1) if month > 1 else (year - 1, 12)
    return year, month


def test_month_subtraction_against_brute_force(spark):
    cases = [(y, m, n) for y in (2021, 2022) for m in range(1, 13) for n in range(40)]
    df = spark.createDataFrame(cases, "y int, m int, n int")
    got = df.select("y", "m", "n", dates.subtract_months(F.col("y"), F.col("m"), F.col("n")).alias("r"))
    for row in got.collect():
        assert (row.r.year, row.r.month) == month_back(row.y, row.m, row.n)


@pytest.mark.parametrize("given, n, expected", [((2022, 1), 1, (2021, 12)), ((2022, 3), 15, (2020, 12)), ((2022, 12), 0, (2022, 12)), ((2022, 12), -1, (2023, 1))])
def test_month_wrap(spark, given, n, expected):
    shifted = dates.subtract_months(F.lit(given[0]), F.lit(given[1]), n)
    row = spark.range(1).select(shifted.alias("r")).first().r
    assert (row.year, row.month) == expected
    moved = month_shift(datetime.date(*given, 1), -n)
    assert (moved.year, moved.month) == expected


@pytest.mark.parametrize("month", [0, 13])
def test_month_out_of_range_stops_the_job(spark, month):
    df = spark.createDataFrame([(2022, month)], "y int, m int")
    with pytest.raises(Exception, match="month is out of range"):
        df.select(dates.subtract_months(F.col("y"), F.col("m"), 1)).collect()


def test_previous_month_and_thirty_days_back_differ(spark):
    day = F.lit("2022-03-02").cast("date")
    row = spark.range(1).select(dates.previous_month_id(day).alias("p"), dates.days_back(day).alias("b")).first()
    assert row.p == "202202"
    assert tuple(row.b) == ("202201", "2022", "01")


def test_month_id_pads_and_never_cuts(spark):
    df = spark.createDataFrame([(2022, 1), (2022, 12), (2022, 123)], "y int, m int")
    assert [r[0] for r in df.select(dates.month_id_of(F.col("y"), F.col("m"))).collect()] == ["202201", "202212", "2022123"]


def test_run_month_and_stamp(spark):
    day = F.lit("2022-08-28 15:36:39").cast("timestamp_ntz")
    row = spark.range(1).select(dates.run_month(day).alias("r"), dates.run_stamp(day).alias("s"), dates.run_stamp().alias("now"), dates.run_month().alias("today")).first()
    assert tuple(row.r) == (2022, 8)
    assert row.s == "20220828T153639"
    assert re.fullmatch(r"\d{8}T\d{6}", row.now)
    assert row.today.year >= 2024


def test_json_total_golden(spark):
    df = document_source(spark, '{"1001": 301.27, "1002": 433.21, "1003": 502.22}', "{}")
    total = documents.map_total(documents.number_map(F.col("document")))
    results = [json.loads(r[0]) for r in df.select(documents.result_document(total_order_value=total)).collect()]
    assert results[0]["total_order_value"] == pytest.approx(1236.7)
    assert results[1]["total_order_value"] == 0


def test_bad_json_stops_the_job(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        document_source(spark, '{"a": ').select(documents.number_map(F.col("document"))).collect()


def test_text_document_writes_strings(spark):
    document = documents.text_document(at=F.lit("2021-10-23 00:00:00").cast("timestamp_ntz"), n=F.lit(1), b=F.lit(False))
    assert json.loads(spark.range(1).select(document).first()[0]) == {"at": "2021-10-23 00:00:00", "n": "1", "b": "false"}


def test_random_integers_cover_one_to_ten_and_repeat(spark):
    df = spark.range(0, 2000, 1, 4)
    first = rows(df.select(names.random_integer(3).alias("x")))
    assert {r[0] for r in first} == set(range(1, 11))
    assert first == rows(df.select(names.random_integer(3).alias("x")))


def test_job_names(spark):
    got = spark.range(1).select(
        names.job_name("train", F.lit("MY"), F.lit("202207"), F.lit("age")), names.job_name("label", F.lit("SG"), F.lit("202207"))
    ).first()
    assert tuple(got) == ("demographic_training_MY_age_202207", "demographic_label_generation_SG_202207")
