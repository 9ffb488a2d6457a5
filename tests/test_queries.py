"""Every registered query against its SQL on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_queries import compare  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from conftest import plan  # noqa: E402


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, folder, name):
    assert compare(spark, folder, name) == ""


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["event_id", "user_id", "event_type", "value", "date"]


@pytest.mark.parametrize("name, shuffles", [("day_slice", 0), ("daily_agg", 1), ("monthly_features", 1), ("period_pivot", 1), ("best_candidate", 1), ("best_gate", 1), ("carrier_switches", 1), ("request_features", 1), ("log_latest", 1), ("json_map_total", 1)])
def test_shuffles(spark, folder, name, shuffles):
    assert plan(entry.queries()[name](spark, folder)).count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize("name", list(entry.queries()))
def test_no_query_pairs_all_rows_of_a_group(spark, folder, name):
    if name in ("market_models", "fallback_score", "train_score_gbt", "train_score_lr", "pca"):
        pytest.skip("runs a training; its joins are those of churn_training_set")
    text = plan(entry.queries()[name](spark, folder))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
