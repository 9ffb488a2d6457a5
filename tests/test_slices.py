import datetime

import pytest
from pyspark.sql import functions as F, types as T

from conftest import plan, rows
from monthmill.operators import slices, steps

DAY = "2022-09-18"
USERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("email", T.StringType()),
        T.StructField("phone", T.StringType()),
        T.StructField("isKycApproved", T.BooleanType()),
        T.StructField("userType", T.StringType()),
        T.StructField("createdAt", T.StringType()),
    ]
)
TIMES = ["2022-09-18 00:00:00", "2022-09-18 23:59:59", "2022-09-19 00:00:00", "2022-09-18T10:00:00", None]


@pytest.fixture
def users(spark):
    return spark.createDataFrame([(i + 1, "e", "p", True, "t", at) for i, at in enumerate(TIMES)], USERS)


def test_text_times_are_split_at_the_blank(users):
    day = slices.day_slice(users, DAY)
    assert day.columns == ["id", "email", "phone", "isKycApproved", "userType", "date"]
    assert [(r.id, r.date) for r in day.orderBy("id").collect()] == [(1, DAY), (2, DAY)]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_times_give_the_same_rows_as_their_text(users, kind):
    timed = users.where("id <> 4").withColumn("createdAt", F.col("createdAt").cast(kind))
    assert rows(slices.day_slice(timed, DAY)) == rows(slices.day_slice(users, DAY))


def test_dates(spark):
    days = spark.createDataFrame([(1, datetime.date(2022, 9, 18)), (2, datetime.date(2022, 9, 19))], "id int, createdAt date")
    assert rows(slices.day_slice(days, DAY, columns=["id"])) == [(1, DAY)]


def test_a_bad_day_is_refused(users):
    with pytest.raises(ValueError):
        slices.day_slice(users, "yesterday")


def test_range_and_columns_reach_the_scan(spark, folder):
    events = spark.read.parquet(f"{folder}/events.parquet")
    text = plan(slices.day_slice(events, "2024-01-05", "ts", ["event_id"]))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in text
    assert "LessThan(ts,2024-01-06T00:00)" in text
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in text


def test_the_separator_is_a_regular_expression(spark):
    df = spark.range(1).select(slices.first_part(F.lit("a1b2c"), "[0-9]").alias("x"))
    assert df.first().x == "a"


def test_first_row_takes_no_full_sort(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    first = slices.first_row(orders, "o_orderkey")
    assert first.first().o_orderkey == 0
    assert "TakeOrderedAndProject" in plan(first)


def test_steps_make_one_plan(users):
    out = steps.run_steps(users, lambda df: slices.day_slice(df, DAY), lambda df: df.where("id > 1"))
    assert [r.id for r in out.collect()] == [2]


def test_python_batches(spark):
    df = steps.map_batches(spark.range(10), lambda pdf: pdf.assign(double=pdf["id"] * 2), "id long, double long")
    assert rows(df) == [(i, 2 * i) for i in range(10)]
