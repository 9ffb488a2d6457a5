"""Inputs that a review found to give wrong rows."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from monthmill.functions import documents

from monthmill.operators import gates, prep, shares


def test_classes_of_one_side_stay(spark):
    predicted = spark.createDataFrame([("A", "x", 0.5), ("A", "y", 0.5)], "market string, class string, share double")
    target = spark.createDataFrame([("A", "x", 0.25), ("A", "z", 0.75)], "market string, class string, target_share double")
    found = shares.class_weights(predicted, target, "market", "class").select("class", "weight")
    assert rows(found) == [("x", 0.5), ("y", None), ("z", None)]


def test_group_without_metrics_stays(spark):
    df = spark.createDataFrame([("g", "b", 2), ("g", "a", 2), ("g", "c", None), ("h", "d", None)], "k string, c string, m int")
    assert rows(gates.best_candidate(df, ["k"], "m", "c")) == [("g", "a", 2), ("h", None, None)]


def test_standard_scale_of_few_and_equal_values(spark):
    one = spark.createDataFrame([(3.0,)], "x double")
    assert [r.x_std for r in prep.standard_scale(one, ["x"]).collect()] == [0.0]
    equal = spark.createDataFrame([(3.0,), (3.0,), (None,)], "x double")
    assert rows(prep.standard_scale(equal, ["x"]).select("x_std")) == [(0.0,), (0.0,), (None,)]


def test_the_last_value_of_a_repeated_member_counts(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',), ('{"a":1,"b":2,"a":5}',), ("{}",), ('{"x":4}',)], "d string")
    got = df.select(documents.map_total(documents.number_map(F.col("d"))).alias("t"))
    assert [r.t for r in got.collect()] == [2.0, 7.0, 0.0, 4.0]


def test_a_member_without_a_number_stops_the_job(spark):
    df = spark.createDataFrame([('{"a":null,"b":2}',)], "d string")
    with pytest.raises(Exception, match="no number"):
        df.select(documents.map_total(documents.number_map(F.col("d")))).collect()
