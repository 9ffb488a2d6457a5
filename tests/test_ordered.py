"""The chunked ways must give the rows of a plain window, for groups of any size."""

import random

import pytest
from pyspark.sql import Window, functions as F

from conftest import rows
from monthmill.operators import ordered


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with most rows, a NULL key, small keys, ties in time and missing values."""
    pick = random.Random(5)
    data = []
    for i in range(4000):
        key = pick.choices(["hot", None, "a", "b", "c"], [60, 25, 5, 5, 5])[0]
        data.append((key, pick.randrange(300), i, pick.choice(["x", "y", None])))
    return spark.createDataFrame(data, "k string, t int, id int, v string").repartition(5).cache()


HOT = 500


def test_row_numbers(skewed):
    order = [F.desc("t"), F.asc("id")]
    got = ordered.row_numbers(skewed, ["k"], order, "rn", HOT)
    expected = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    assert rows(got) == rows(expected)


def test_with_previous(skewed):
    got = ordered.with_previous(skewed, ["k"], ["t", "id"], "v", "before", HOT)
    expected = skewed.withColumn("before", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(got) == rows(expected)


def test_forward_fill(skewed):
    sparse = skewed.withColumn("v", F.when(F.col("id") % 97 == 0, F.col("id")))
    got = ordered.forward_fill(sparse, ["k"], ["t", "id"], "v", "filled", HOT)
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = sparse.withColumn("filled", F.last("v", ignorenulls=True).over(window))
    assert rows(got) == rows(expected)


def test_hot_groups_are_found_and_spread(skewed):
    hot = ordered.hot_groups(skewed, ["k"], HOT)
    assert hot.count() == 2
    chunks = ordered._chunks(skewed.where("k = 'hot'"), ["k"], ["t", "id"], 2400, HOT)
    sizes = [r["count"] for r in chunks.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 1500


def test_no_hot_group_leaves_a_plain_window(skewed):
    assert ordered.hot_groups(skewed, ["k"], 10_000).isEmpty()
    got = ordered.with_previous(skewed, ["k"], ["t", "id"], "v", "before")
    expected = skewed.withColumn("before", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
    assert rows(got) == rows(expected)


def test_any_number_of_hot_groups_is_split(spark):
    many = spark.range(33_000).select((F.col("id") % 11_000).alias("k"), "id")
    hot = ordered.hot_groups(many, ["k"], 2)
    cold, rest = ordered.parted(many, ["k"], hot)
    assert hot.count() == 11_000 and cold.isEmpty() and rest.count() == 33_000
    df = spark.range(480).select((F.col("id") % 40).alias("k"), "id")
    got = ordered.with_previous(df, ["k"], ["id"], "id", "before", 11)
    expected = df.withColumn("before", F.lag("id").over(Window.partitionBy("k").orderBy("id")))
    assert rows(got) == rows(expected)


def test_last_known_value(skewed):
    got = ordered.with_previous(skewed, ["k"], ["t", "id"], "v", "before", HOT, known=True)
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    assert rows(got) == rows(skewed.withColumn("before", F.last("v", ignorenulls=True).over(window)))
