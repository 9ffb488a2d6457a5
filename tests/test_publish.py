import pytest
from pyspark.sql import functions as F

from conftest import rows
from monthmill.operators import labels
from monthmill.plans.cycle import label_job
from monthmill.sinks import publish

SHAPE = "user_id int, label int, market string, data_month string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SHAPE)


def seen(spark, base):
    fields = spark.createDataFrame([], SHAPE).schema.fields[:2]
    return rows(publish.published(spark, base, fields))


def rules():
    return {"a class": F.col("label").isin(0, 1)}


def test_a_run_is_seen_whole_or_not_at_all(spark, tmp_path):
    base = str(tmp_path)
    assert seen(spark, base) == []
    publish.publish(frame(spark, (1, 0, "MY", "200107"), (2, 1, "SG", "200107")), base, rules(), ["user_id"])
    before = [(1, 0, "MY", "200107"), (2, 1, "SG", "200107")]
    assert seen(spark, base) == before

    def killed(run):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        publish.publish(frame(spark, (1, 1, "MY", "200107")), base, rules(), before_commit=killed)
    assert seen(spark, base) == before and len(list((tmp_path / "runs").iterdir())) == 2
    # A later run replaces only the markets and months it has.
    publish.publish(frame(spark, (1, 1, "MY", "200107"), (3, 0, "MY", "200108")), base, rules())
    assert seen(spark, base) == [(1, 1, "MY", "200107"), (2, 1, "SG", "200107"), (3, 0, "MY", "200108")]


def test_broken_runs_are_refused(spark, tmp_path):
    base = str(tmp_path)
    publish.publish(frame(spark, (1, 0, "MY", "200107")), base)
    for data, what in [([(1, 7, "MY", "200107")], "a class"), ([(1, None, "MY", "200107")], "a class"), ([(1, 0, "MY", "200107")] * 2, "repeat")]:
        with pytest.raises(publish.Refused, match=what):
            publish.publish(frame(spark, *data), base, rules(), ["user_id"])
    assert seen(spark, base) == [(1, 0, "MY", "200107")]


def test_covered_months_without_rows_and_repeated_commits(spark, tmp_path):
    base = str(tmp_path)
    first = publish.publish(frame(spark, (1, 0, "MY", "200107"), (2, 0, "SG", "200107")), base)
    publish.publish(frame(spark, (2, 1, "SG", "200107")), base, covers=[("MY", "200107"), ("SG", "200107")])
    assert seen(spark, base) == [(2, 1, "SG", "200107")]
    # A commit that is repeated, as after a lost answer, does not bring the old run back.
    assert publish.commit(spark, base, first, {("MY", "200107"): 1}) == 1
    assert seen(spark, base) == [(2, 1, "SG", "200107")]
    publish.publish(frame(spark), base, covers=[("SG", "200107")])
    assert seen(spark, base) == []
    assert len(list((tmp_path / "commits").glob("part-*"))) == 3


def test_labels_of_both_routes(spark, tmp_path):
    users = spark.createDataFrame([(1, "MY"), (2, "MY"), (3, "MY"), (4, "SG"), (5, "SG"), (6, "LK"), (7, "SG"), (8, None)], "user_id int, market string")
    known = spark.createDataFrame([(1, 0, 1), (2, 0, None), (3, 1, 0), (4, 1, 1), (6, 1, 1)], "user_id int, age int, gender int")
    usage = spark.createDataFrame(
        [(u, "a") for u in (1, 2, 3, 4, 4, 5, 6)] + [(u, "b") for u in (1, 3, 4)] + [(3, "c"), (3, "c"), (5, "c"), (7, None), (8, "a")], "user_id int, app string")
    apps = labels.accurate_apps(usage, labels.own_labels(known.where("user_id < 4"), ["age", "gender"]), 0.6, 2)
    # App a: ages 0, 0, 1 and genders 1, 0; app b: ages 0, 1 and genders 1, 0; app c has one user.
    assert rows(apps) == [("a", "age", 0, 3)]
    found = labels.market_labels(usage, known, users, ["age", "gender"], least_users=2)
    own = [(1, "MY", "own", "age", 0), (1, "MY", "own", "gender", 1), (2, "MY", "own", "age", 0), (3, "MY", "own", "age", 1), (3, "MY", "own", "gender", 0)]
    assert rows(found) == sorted(own + [(4, "SG", "shared", "age", 0), (5, "SG", "shared", "age", 0)], key=repr)
    label_job(usage, known, users, ["age", "gender"], "200107", str(tmp_path), least_users=2)
    assert publish.current(spark, str(tmp_path)).where("n_rows > 0").count() == 2
