import datetime
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from monthmill.operators import features, gates, lookups, shares

JULY = datetime.date(2022, 7, 1)


@pytest.fixture(scope="module")
def requests(spark):
    """Users with gaps, a hot user, and times at the borders of months."""
    pick = random.Random(2)
    start = datetime.datetime(2021, 11, 1)
    data = []
    for i in range(3000):
        user = pick.choices([1, *range(2, 40)], [60, *[1] * 38])[0]
        at = start + datetime.timedelta(minutes=pick.randrange(300 * 24 * 60))
        data.append((i, user, at, pick.choice(["A", "B"])))
    data += [(3000, 99, datetime.datetime(2022, 2, 1), "A"), (3001, 99, datetime.datetime(2022, 7, 31, 23, 59, 59), "B")]
    data += [(3002, 99, datetime.datetime(2022, 1, 31, 23, 59, 59), "A"), (3003, 99, datetime.datetime(2022, 8, 1), "A")]
    return spark.createDataFrame(data, "id long, user long, ts timestamp_ntz, carrier string").cache()


def brute(requests):
    """The features of each user, computed row by row."""
    users = {}
    for r in sorted(requests.collect(), key=lambda r: (r.ts, r.id)):
        k = (JULY.year - r.ts.year) * 12 + JULY.month - r.ts.month
        if 0 <= k < 6:
            users.setdefault(r.user, []).append((k, r))
    out = []
    for user, found in users.items():
        line = [user, found[-1][1].carrier]
        for k in range(6):
            line += [sum(a == k for a, _ in found), len({r.ts.date() for a, r in found if a == k})]
        carriers = [r.carrier for _, r in found]
        out.append((*line, sum(a != b for a, b in zip(carriers, carriers[1:]))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("hot_rows", [10_000, 200])
def test_request_features_against_brute_force(requests, hot_rows):
    got = features.request_features(requests, "user", ["ts", "id"], "carrier", JULY, hot_rows=hot_rows)
    assert rows(got) == brute(requests)
    assert got.columns[:4] == ["user", "carrier", "brq_count_p_0", "num_days_p_0"]


def test_features_need_one_shuffle_by_user(requests):
    text = plan(features.request_features(requests, "user", ["ts", "id"], "carrier", JULY))
    assert text.count("Exchange hashpartitioning(user") == 1


def test_periods_at_month_borders(requests):
    row = features.period_features(requests.where("user = 99"), "user", "ts", JULY).first()
    assert (row.brq_count_p_0, row.brq_count_p_5, row.num_days_p_5, row.brq_count_p_3) == (1, 1, 1, 0)


def test_monthly_activity(requests):
    got = features.monthly_activity(requests, "user", "ts")
    expected = requests.groupBy("user", F.trunc(F.to_date("ts"), "MM").alias("month")).agg(
        F.count("*").alias("brq_count"), F.countDistinct(F.to_date("ts")).alias("num_days")
    )
    assert rows(got) == rows(expected)
    assert plan(got).count("Exchange") == 1


def test_switches_golden(spark):
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, "A"), (1, 3, "B"), (1, 4, "A"), (2, 1, "A")], "u int, t int, c string")
    assert rows(features.carrier_switches(df, "u", ["t"], "c")) == [(1, 2), (2, 0)]


def test_single_carrier_ignores_null_and_drops_users_without_any(spark):
    df = spark.createDataFrame([(1, "A"), (1, None), (2, "A"), (2, "B"), (3, None)], "u int, c string")
    assert rows(features.keep_single_carrier(df, "u", "c")) == [(1, "A"), (1, None)]


def test_churn_label_and_next_month(requests):
    known = features.period_features(requests, "user", "ts", JULY)
    labels = {r.user: r.is_churn for r in features.churn_labels(requests, known, "user", "ts", JULY).collect()}
    later = {r.user for r in requests.collect() if (r.ts.year, r.ts.month) == (2022, 8)}
    assert labels == {u: int(u not in later) for u in labels} and labels[99] == 0


def test_next_label_crosses_the_year(spark):
    months = [(1, datetime.date(2021, 12, 1)), (1, datetime.date(2022, 2, 1))]
    known = spark.createDataFrame(months, "u int, month date")
    labels = spark.createDataFrame([(1, datetime.date(2022, 1, 1), 7), (1, datetime.date(2022, 2, 1), 8)], "u int, month date, label int")
    assert rows(features.with_next_label(known, labels, "u")) == [(1, datetime.date(2021, 12, 1), 7)]
    early = features.next_month_labels(labels, "u", "month", label=F.max("label"))
    assert rows(known.join(early, ["u", "month"])) == [(1, datetime.date(2021, 12, 1), 7)]


def test_gate_goldens(spark):
    df = spark.createDataFrame([("r", "A", 3), ("r", "B", 8), ("r", "C", 5), ("s", "A", 3), ("s", "B", 7), ("s", "C", None)], "run string, c string, m int")
    best = gates.best_metric(df, ["run"], "m", 8)
    assert rows(best) == [("r", 8, 0, "accurate"), ("s", 7, 1, "inaccurate")]
    parts = gates.branches(best)
    assert [r.run for r in parts["accurate"].collect()] == ["r"] and [r.run for r in parts["inaccurate"].collect()] == ["s"]
    assert rows(gates.best_candidate(df, ["run"], "m", "c")) == [("r", "B", 8), ("s", "B", 7)]


def test_best_candidate_takes_the_smallest_id_of_a_tie(spark):
    df = spark.createDataFrame([(1, "b", 5.0), (1, "a", 5.0), (1, "c", None)], "g int, c string, m double")
    assert rows(gates.best_candidate(df, ["g"], "m", "c")) == [(1, "a", 5.0)]


def test_lookups(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, app string")
    ref = spark.createDataFrame([("x", "s1")], "app string, segment string")
    assert rows(lookups.keep_listed(df, ref.select("app"), "app")) == [("x", 1)]
    assert {(r.id, r.segment) for r in lookups.attach(df, ref, "app").collect()} == {(1, "s1"), (2, None), (3, None)}
    assert lookups.with_predictions(df, spark.createDataFrame([(2, 1.0)], "id int, p double"), "id").count() == 3
    assert rows(lookups.missing(df.select("id"), df.where("id = 2").select("id"), ["id"])) == [(1,), (3,)]


@pytest.mark.parametrize("how", ["left_semi", "left", "inner"])
def test_hot_keys_of_a_large_lookup_stay_in_place(spark, monkeypatch, how):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 5)
    pick = random.Random(4)
    data = [(i, pick.choices([1, None, *range(2, 30)], [40, 30, *[1] * 28])[0]) for i in range(800)]
    df = spark.createDataFrame(data, "id int, k int")
    values = spark.createDataFrame([(k, k * k) for k in range(0, 30, 2)] + [(1, 7)], "k int, v int")
    got = lookups.lookup(df, values, "k", how, hot_rows=100)
    assert rows(got) == rows(df.join(values, "k", how))
    assert plan(got).count("BroadcastHashJoin") >= 1


def test_hot_keys_of_another_type_and_repeated_entries(spark, monkeypatch):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    df = spark.createDataFrame([(i, 1) for i in range(100)] + [(200, 2)], "id int, k int")
    wide = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert lookups.keep_listed(df, wide, "k", hot_rows=50).count() == 101
    same = wide.withColumn("k", F.col("k").cast("int"))
    assert lookups.keep_listed(df, same, "k", hot_rows=50).count() == 101


def test_single_carrier_of_a_hot_user(spark):
    data = [(1, "A")] * 50 + [(2, "A"), (2, "B")] * 30 + [(3, "C"), (4, None)]
    df = spark.createDataFrame(data, "u int, c string")
    expected = [(1, "A")] * 50 + [(3, "C")]
    assert rows(features.keep_single_carrier(df, "u", "c", hot_rows=40)) == expected


@pytest.mark.parametrize("limit", [0, 10_000])
def test_group_values_join_null_keys_on_both_ways(spark, monkeypatch, limit):
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", limit)
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, k string")
    values = spark.createDataFrame([("x", 10), (None, 20)], "k string, v int")
    joined = lookups.attach_group_values(df, values, ["k"])
    assert rows(joined) == [(1, "x", 10), (2, None, 20), (3, "z", None)]


def test_class_weights(spark):
    users = spark.createDataFrame([("MY", "a"), ("MY", "a"), ("MY", "b"), ("MY", "b"), ("TH", "a")], "market string, class string")
    target = spark.createDataFrame([("MY", "a", 0.75), ("MY", "b", 0.25), ("TH", "a", 1.0)], "market string, class string, target_share double")
    weights = shares.class_weights(shares.class_shares(users, "market", "class"), target, "market", "class")
    assert {(r.market, r["class"]): r.weight for r in weights.collect()} == {("MY", "a"): 1.5, ("MY", "b"): 0.5, ("TH", "a"): 1.0}


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_switches_pass_over_missing_carriers(spark, hot_rows):
    data = [(1, 1, "A"), (1, 2, None), (1, 3, "B"), (1, 4, None), (1, 5, None), (1, 6, "B"), (1, 7, "A"), (2, 1, None), (2, 2, None), (2, 3, None)]
    df = spark.createDataFrame(data, "u int, t int, c string")
    assert rows(features.carrier_switches(df, "u", ["t"], "c", hot_rows)) == [(1, 2), (2, 0)]
