import datetime
import random

from conftest import plan, rows
from monthmill.operators import features, monthstore

MONTH = datetime.date(2022, 6, 1)
SHAPE = "user int, at timestamp, nr int, carrier string"


def made(spark, seed):
    rng = random.Random(seed)
    start = datetime.datetime(2021, 11, 1)
    data = [(rng.randrange(25), start + datetime.timedelta(minutes=rng.randrange(60 * 24 * 270)), i, rng.choice(["a", "b", None])) for i in range(900)]
    return spark.createDataFrame(data + [(77, start, 0, "a"), (78, datetime.datetime(2022, 6, 30, 23, 59), 1, None)], SHAPE)


def test_same_as_from_all_rows(spark, tmp_path):
    base = str(tmp_path)
    df = made(spark, 1)
    for back in range(6):
        monthstore.store_month(df, base, "user", ["at", "nr"], "carrier", features.month_shift(MONTH, -back))
    found = monthstore.stored_features(spark, base, df.schema["user"], df.schema["carrier"], MONTH)
    right = features.request_features(df, "user", ["at", "nr"], "carrier", MONTH)
    assert found.columns == right.columns and rows(found) == rows(right)
    # A month that is written again replaces itself; a later reference month reads one more.
    monthstore.store_month(df, base, "user", ["at", "nr"], "carrier", MONTH)
    monthstore.store_month(df, base, "user", ["at", "nr"], "carrier", features.month_shift(MONTH, 1))
    later = features.month_shift(MONTH, 1)
    found = monthstore.stored_features(spark, base, df.schema["user"], df.schema["carrier"], later)
    assert rows(found) == rows(features.request_features(df, "user", ["at", "nr"], "carrier", later))


def test_plans(spark, tmp_path):
    """Adding a month reads that month; the features read stored months and shuffle once."""
    source = str(tmp_path / "raw")
    made(spark, 2).write.parquet(source)
    df = spark.read.parquet(source)
    text = plan(monthstore.month_summary(df, "user", ["at", "nr"], "carrier", MONTH))
    assert "GreaterThanOrEqual(at,2022-06-01" in text and "LessThan(at,2022-07-01" in text
    base = str(tmp_path / "months")
    monthstore.store_month(df, base, "user", ["at", "nr"], "carrier", MONTH)
    text = plan(monthstore.stored_features(spark, base, df.schema["user"], df.schema["carrier"], MONTH))
    assert text.count("Exchange hashpartitioning") == 1 and "PartitionFilters" in text
