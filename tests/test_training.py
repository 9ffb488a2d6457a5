import hashlib
import random

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window, functions as F

from conftest import plan, rows
from monthmill.operators import metrics, models, prep
from monthmill.sinks.files import save_model


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0), (None, 5.0)], "x double, c double")
    got = prep.minmax_scale(prep.standard_scale(df, ["x", "c"]), ["x", "c"]).collect()
    assert [r.x_norm for r in got] == [0.0, 0.2, 1.0, None]
    assert [r.c_norm for r in got] == [0.0] * 4 and [r.c_std for r in got] == [0.0] * 4
    assert [r.x_std for r in got][:3] == pytest.approx([-0.755929, -0.377964, 1.133893], abs=1e-6)


def test_scaling_has_no_join(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_totalprice")
    assert "Join" not in plan(prep.standard_scale(orders, ["o_totalprice"]))


@pytest.fixture(scope="module")
def classes(spark):
    data = [(i, "big" if i % 10 else ("small" if i % 20 else None)) for i in range(4000)]
    return spark.createDataFrame(data, "id long, c string").repartition(4).cache()


def test_upsample(classes):
    got = prep.upsample(classes, "c").groupBy("c").count()
    # 3600 big, 200 small and 200 without a class, which count as a class of their own.
    assert rows(got) == [("big", 3600), ("small", 3600), (None, 3600)]


@pytest.mark.parametrize("wanted", [0, 1, 57, 200, 300, 5000])
def test_pick_per_class_against_brute_force(classes, wanted):
    found = {}
    for r in classes.collect():
        found.setdefault(r.c, []).append((hashlib.md5(str(r.id).encode()).hexdigest(), r.id))
    expected = [(i, c) for c, ids in found.items() for _, i in sorted(ids)[:wanted]]
    assert rows(prep.pick_per_class(classes, "c", "id", wanted)) == sorted(expected, key=repr)


def test_balance_with_coarse_parts(classes, monkeypatch):
    expected = rows(prep.balance(classes, "c", "id"))
    monkeypatch.setattr(prep, "_PREFIX", 1)
    assert rows(prep.balance(classes, "c", "id")) == expected
    assert len(expected) == 600


def test_split_is_stable_and_near_eighty_percent(classes):
    parts = {r.part: r["count"] for r in prep.with_split(classes, "id").groupBy("part").count().collect()}
    assert 0.77 < parts["train"] / 4000 < 0.83
    digest = hashlib.md5(b"17").hexdigest()
    side = prep.with_split(classes.where("id = 17"), "id").first().part
    assert side == ("train" if int(digest[:8], 16) % 100 < 80 else "test")


def test_positive_weight(spark):
    df = spark.createDataFrame([(1,), (0,)], "y int")
    assert [r.weight for r in prep.with_class_weight(df, "y").collect()] == [0.35, 1.0]


SCORES = {
    "spread": lambda pick: pick.random() * 100,
    "ties": lambda pick: float(pick.randrange(3)),
    "one": lambda pick: 4.0,
    "missing": lambda pick: pick.choice([None, float("nan"), float("inf"), pick.random(), -5.0]),
    "far": lambda pick: pick.choice([1e300, pick.random()]),
}


@pytest.mark.parametrize("kind", SCORES)
@pytest.mark.parametrize("hot_rows", [10_000, 50])
def test_tiles_equal_ntile(spark, kind, hot_rows):
    pick = random.Random(kind)
    data = [(i, pick.choices(["a", "b", "tiny"], [80, 19, 1])[0], SCORES[kind](pick)) for i in range(1003)]
    df = spark.createDataFrame(data, "id long, g string, s double").repartition(3).cache()
    got = metrics.with_tiles(df, ["g"], "s", "id", hot_rows=hot_rows).select("id", "decile")
    expected = df.select("id", F.ntile(10).over(Window.partitionBy("g").orderBy(F.desc("s"), "id")).alias("decile"))
    assert rows(got) == rows(expected)


def test_deciles_of_many_groups_shuffle_only_border_bins(spark):
    df = spark.range(40_000).select("id", (F.col("id") % 100).alias("g"), F.rand(3).alias("s"))
    got = metrics.with_tiles(df, ["g"], "s", "id")
    assert "SortMergeJoin" not in plan(got) and "ShuffledHashJoin" not in plan(got)
    counts = got.groupBy("g", "decile").count()
    assert counts.count() == 1000 and counts.where("count <> 40").isEmpty()


def test_quality_gate(spark):
    df = spark.createDataFrame([("a", 1, 1)] * 9 + [("a", 0, 1)] + [("b", 1, 1), ("b", None, 1)], "m string, p int, y int")
    assert rows(metrics.quality_gate(df, ["m"], "p", "y")) == [("a", 10, 0.9, "accurate"), ("b", 2, 0.5, "inaccurate")]


@pytest.fixture(scope="module")
def points(spark):
    """Three classes that lie apart, in two markets."""
    pick = random.Random(1)
    data = []
    for i in range(300):
        c = i % 3
        data.append((i, "MY" if i % 2 else "TH", [c * 4 + pick.gauss(0, 0.5), pick.gauss(0, 0.5)], float(c), float(c > 0)))
    df = spark.createDataFrame(data, "id long, market string, v array<double>, age double, gender double")
    return df.withColumn("features", array_to_vector("v")).drop("v").cache()


def accuracy(scored, label):
    return scored.select(metrics.accuracy_of(F.col("prediction"), F.col(label))).first()[0]


def test_logistic_keeps_inputs_and_separates(points):
    scored = models.score(points, models.train(points, models.logistic("age")))
    assert scored.columns == [*points.columns, "prediction", "score"]
    assert scored.count() == 300 and accuracy(scored, "age") > 0.97


def test_boosted_for_two_and_three_classes(points):
    gender = models.score(points, models.train(points, models.boosted("gender", rounds=2)))
    assert accuracy(gender, "gender") > 0.97
    age = models.score(points, models.train(points, models.boosted("age", classes=3, rounds=2)))
    assert accuracy(age, "age") > 0.97 and age.where("score between 0 and 1").count() == 300


def test_boosted_takes_the_fixed_parameters():
    trees = models.boosted("y")
    assert (trees.getMaxBins(), trees.getMaxDepth()) == (50, 7)


def test_markets_and_stored_fallback(spark, points, tmp_path):
    fitted = models.train_markets(points, ["MY"], models.logistic("gender"))
    everywhere = models.train(points, models.logistic("gender"))
    save_model(everywhere, str(tmp_path), "all", "gender", "202207")
    path = save_model(everywhere, str(tmp_path), "all", "gender", "202207")
    assert path.endswith("/all/gender/202207")
    historical = models.stored_model(str(tmp_path), "all", "gender", "202207")
    lost = points.withColumn("market", F.when(F.col("id") % 5 > 0, F.col("market")))
    scored = models.score_markets(lost, fitted, historical)
    assert scored.count() == 300 and scored.select("id").distinct().count() == 300


def test_assembled_columns_take_unseen_categories(spark):
    df = spark.createDataFrame([(1.0, "A", 1.0), (0.0, "B", 0.0)] * 20, "x double, carrier string, y double")
    model = models.train(df, models.assembled(["x"], models.logistic("y"), ["carrier"]))
    new = spark.createDataFrame([(1.0, "Z")], "x double, carrier string")
    assert models.score(new, model).columns == ["x", "carrier", "prediction", "score"]
    assert models.score(new, model).count() == 1


def test_principal_components(points):
    scores, model = prep.principal_components(points.select("id", "features"), "features", 2)
    shares = model.explainedVariance.toArray()
    assert shares[0] > 0.9 and sum(shares) == pytest.approx(1)
    spread = scores.select(F.var_samp("pc_1").alias("a"), F.var_samp("pc_2").alias("b")).first()
    assert spread.a / (spread.a + spread.b) == pytest.approx(shares[0])


def test_types_by_market_and_options(points):
    flat = points.withColumn("x", F.col("id") % 7).withColumn("market", F.when(F.col("id") % 9 > 0, F.col("market")))
    numbers = ["x", "age"]
    made = {k: {"v1": models.assembled(numbers, models.logistic(k), scale=True, components=2)} for k in ("age", "gender")}
    trained = models.train_types(flat.drop("features"), made)
    assert {k: sorted(v) for k, v in trained.items()} == {"age": ["MY", "TH"], "gender": ["MY", "TH"]}
    rest = {k: models.train(flat.drop("features"), made[k]["v1"]) for k in made}
    scored = models.score_types(flat.drop("features"), trained, rest)
    assert scored.count() == 600 and scored.where("score IS NULL").isEmpty()
    assert accuracy(scored.where("model_type = 'gender'"), "gender") > 0.97


def test_training_rows_by_options(classes):
    known = classes.where("c IS NOT NULL").withColumn("y", F.when(F.col("c") == "small", 1).otherwise(0))
    assert prep.training_rows(known, "y", "id").columns == known.columns
    assert rows(prep.training_rows(known, "y", "id", upsampled=True).groupBy("y").count()) == [(0, 3600), (1, 3600)]
    even = prep.training_rows(known, "y", "id", balanced=True, weight=0.35)
    assert rows(even.groupBy("y", "weight").count()) == [(0, 1.0, 200), (1, 0.35, 200)]
