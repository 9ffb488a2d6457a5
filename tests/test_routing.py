import pytest
from pyspark.sql import functions as F

from conftest import rows
from monthmill.operators import routing


def test_manifest_golden(spark):
    markets = routing.market_table(spark).withColumn("data_month", F.lit("202207"))
    jobs = routing.manifest(markets).collect()
    count = {step: sum(j.step == step for j in jobs) for step in ("label", "train", "predict")}
    assert len(jobs) == 36 and count == {"label": 6, "train": 12, "predict": 18}
    names = {j.job for j in jobs}
    assert len(names) == 36
    assert "demographic_training_PH_gender_202207" in names and "demographic_prediction_KH_age_202207" in names


def test_routes(spark):
    got = {r.market: (r.label_source, r.variant) for r in routing.routes(routing.market_table(spark)).collect()}
    assert got["MY"] == ("own", "v1") and got["TH"] == ("shared", "v1") and got["ID"] == ("shared", "v1")
    assert got["BD"] == got["PH"] == got["SG"] == ("shared", "v2")
    assert got["LK"] == got["KH"] == got["MM"] == (None, "fallback")


def test_every_market_gets_the_settings_of_its_size(spark):
    markets = routing.market_table(spark, {"MY": "large", "XX": "small"})
    got = routing.with_settings(markets, routing.settings_table(spark))
    assert {(r.market, r.num_executors, r.executor_memory) for r in got.collect()} == {("MY", 59, "32G"), ("XX", 14, "32G")}


def test_an_unknown_size_stops_the_job(spark):
    markets = routing.market_table(spark, {"MY": "huge"})
    with pytest.raises(Exception, match="no settings for size huge"):
        routing.with_settings(markets, routing.settings_table(spark)).collect()
    with pytest.raises(Exception, match="no settings for size huge"):
        routing.with_settings(markets, routing.settings_table(spark)).select("num_executors").collect()


def test_model_types(spark):
    assert rows(routing.with_model_types(spark.createDataFrame([("MY",)], "market string"))) == [("MY", "age"), ("MY", "gender")]
