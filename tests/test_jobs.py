import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.operators import models
from monthmill.plans.jobs import line_scoring_job
from monthmill.sinks.files import save_model


@pytest.fixture(scope="module")
def people(spark):
    data = [(i, i // 2, "ab"[i % 2] if i < 40 else "a", "xyz"[i % 3], None if i % 50 == 7 else int(i % 4 == 0)) for i in range(200)]
    return spark.createDataFrame(data, "id long, user long, carrier string, kind string, label int").cache()


def test_rows_of_every_switch(people):
    known = people.where("label is not null")
    one = {r.label: r["count"] for r in known.groupBy("label").count().collect()}

    def sizes(switches):
        got = models.switched_rows(people, "label", "id", switches, "user", "carrier")
        return {r.label: r["count"] for r in got.groupBy("label").count().collect()}

    assert sizes(models.Switches()) == one
    assert sizes(models.Switches(upsampled=True)) == {0: one[0], 1: one[1] * (one[0] // one[1])}
    assert sizes(models.Switches(balanced=True)) == {0: min(one.values()), 1: min(one.values())}
    # Users 0..19 have two carriers, except the one whose other row has no label.
    single = models.switched_rows(people, "label", "id", models.Switches(single_carrier=True), "user", "carrier")
    assert {r.user for r in single.select("user").distinct().collect()} == {3, *range(20, 100)}
    weighted = models.switched_rows(people, "label", "id", models.Switches(weight=0.35))
    assert {(r.label, r.weight) for r in weighted.select("label", "weight").distinct().collect()} == {(0, 1.0), (1, 0.35)}


def test_single_carrier_needs_its_columns(people):
    with pytest.raises(ValueError, match="carrier"):
        models.switched_rows(people, "label", "id", models.Switches(single_carrier=True))


def test_training_leaves_the_estimator_alone(people):
    estimator = models.logistic("label", iterations=5)
    models.train_switched(people, "label", "id", [], ["kind"], models.Switches(weight=0.35), estimator)
    assert not estimator.isSet("weightCol")


def test_a_training_stores_counts_whatever_its_rows(people, monkeypatch):
    """Three kinds by two labels reach the fit, not the rows of the table."""
    stored = {}

    def kept(df, label="stored"):
        stored[label] = df.cache()
        return stored[label]

    monkeypatch.setattr(models, "durable", kept)
    for times in (1, 5):
        many = people.crossJoin(people.sparkSession.range(times).select(F.col("id").alias("_time")))
        models.train_switched(many, "label", "id", [], ["kind"], models.Switches(weight=0.35), models.logistic("label"))
        counts = stored.pop("training-counts")
        assert not stored and counts.count() == 6
        assert counts.agg(F.sum("_n")).first()[0] == 196 * times


@pytest.mark.parametrize(
    "switches",
    [models.Switches(), models.Switches(upsampled=True, weight=0.35), models.Switches(scale=True), models.Switches(components=2),
     models.Switches(True, True, False, 0.35, True, 2)],
)
def test_fit_on_counts_equals_fit_on_rows(people, switches):
    """Every stage is the one that the rows give: probabilities, mean and deviation, components."""
    odd = people.withColumn("kind", F.when(F.col("id") % 7 != 0, F.col("kind"))).withColumn("land", F.lit("one"))
    estimator = models.logistic("label", iterations=60).setTol(1e-9)
    given = (odd, "label", "id", [], ["kind", "land"], switches, estimator, "user", "carrier")
    counted = models.train_switched(*given)
    rows = models.switched_rows(odd, "label", "id", switches, "user", "carrier").coalesce(1).cache()
    weighted = estimator.copy().setWeightCol("weight") if switches.weight else estimator
    plain = models.train(rows, models.assembled([], weighted, ["kind", "land"], switches.scale, switches.components))

    def by_kind(model):
        asked = odd.select("kind", "land").distinct().unionByName(odd.select(F.lit("new").alias("kind"), "land").limit(1))
        return {r.kind: r for r in models.score(asked, model).collect()}

    assert by_kind(counted).keys() == by_kind(plain).keys() == {"x", "y", "z", None, "new"}
    for kind, row in by_kind(counted).items():
        assert (row.prediction, row.score) == (by_kind(plain)[kind].prediction, pytest.approx(by_kind(plain)[kind].score, abs=1e-5))
    # Indicators come in the order of counts here and of rows there.
    order = [counted.stages[0].labelsArray[0].index(v) for v in plain.stages[0].labelsArray[0]]
    places = [*order, *range(len(order), 8)]
    scalers = [[s for s in m.stages if type(s).__name__ == "StandardScalerModel"] for m in (counted, plain)]
    for c, p in zip(*scalers, strict=True):
        assert np.allclose(c.mean.toArray()[places], p.mean.toArray(), atol=1e-12)
        assert np.allclose(c.std.toArray()[places], p.std.toArray(), atol=1e-12)
    found = [[s for s in m.stages if type(s).__name__ == "PCAModel"] for m in (counted, plain)]
    for c, p in zip(*found, strict=True):
        assert np.allclose(c.explainedVariance.toArray(), p.explainedVariance.toArray(), atol=1e-9)
        assert np.allclose(np.abs(c.pc.toArray()[places]), np.abs(p.pc.toArray()), atol=1e-6)


def test_penalised_and_numeric_fits_keep_their_rows(people, monkeypatch):
    stored = {}
    original = models.durable
    monkeypatch.setattr(models, "durable", lambda df, label="stored": stored.setdefault(label, original(df, label)))
    models.train_switched(people, "label", "id", [], ["kind"], models.Switches(), models.logistic("label").setRegParam(0.1))
    assert stored.pop("training-rows").count() == 196 and not stored
    models.train_switched(people, "label", "id", ["user"], ["kind"], models.Switches(), models.logistic("label"))
    assert stored.pop("training-rows").count() == 196 and not stored


def test_each_model_scores_every_row(people):
    known = people.withColumn("kind", F.when(F.col("id") % 7 != 0, F.col("kind")))
    estimator = models.logistic("label", iterations=5)
    fitted = {
        "one": models.train_switched(known, "label", "id", [], ["kind"], models.Switches(), estimator),
        "two": models.train_switched(known, "label", "id", [], ["kind"], models.Switches(weight=0.35), estimator),
    }
    got = models.score_each(known, fitted, ["kind"])
    assert got.columns == [*known.columns, "one", "two"] and got.count() == 200
    for name, model in fitted.items():
        wanted = {r.id: (r.prediction, r.score) for r in models.score(known, model).collect()}
        assert {r.id: tuple(r[name]) for r in got.collect()} == wanted


def test_latest_model_of_an_earlier_month(spark, people, tmp_path):
    known = people.where("label is not null")
    base = str(tmp_path)
    for month, share in (("200011", 0), ("200012", 1), ("200102", 0)):
        rows = known.withColumn("label", F.lit(share)).unionByName(known.limit(1).withColumn("label", F.lit(1 - share)))
        save_model(models.train(rows, models.assembled([], models.logistic("label", iterations=5), ["kind"])), base, "all", "churn", month)
    found = models.latest_model(spark, base, "all", "churn", "200101")
    assert {r.prediction for r in models.score(known, found).select("prediction").collect()} == {1.0}
    with pytest.raises(FileNotFoundError):
        models.latest_model(spark, base, "all", "churn", "200011")
    with pytest.raises(FileNotFoundError):
        models.latest_model(spark, base, "MY", "churn", "200101")


def test_lines_that_are_no_records_stop_the_job(spark, people, tmp_path):
    model = models.train(people.where("label is not null"), models.assembled([], models.logistic("label", iterations=5), ["kind"]))
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.csv").write_text("1,x\nnone,y\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        models.score_lines(spark, str(tmp_path / "lines"), "id long, kind string", model, "id", str(tmp_path), "out").collect()


def test_every_line_comes_back(spark, folder):
    got = line_scoring_job(spark, folder)
    assert got.count() == spark.read.parquet(f"{folder}/customer.parquet").count()
    assert got.where("prediction is null or score is null").count() == 0
