import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.operators import trees
from monthmill.operators.trees import Settings, fit_trees, score_trees


def by_hand(x, y, base, settings, leaves):
    """One tree for two classes, split leaf by leaf over all thresholds: the value each row gets."""
    p = 1 / (1 + np.exp(-base))
    g = np.rint((p - y) * trees.UNIT) / trees.UNIT
    h = np.full(len(y), np.rint(max(p * (1 - p), 1e-6) * trees.UNIT) / trees.UNIT)

    def best(rows, depth):
        found = (0.0, None, None)
        if depth >= settings.depth:
            return found
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= cut]
                right = rows[x[rows, f] > cut]
                if min(len(left), len(right)) < settings.least_rows:
                    continue
                gain = sum(g[s].sum() ** 2 / h[s].sum() for s in (left, right)) - g[rows].sum() ** 2 / h[rows].sum()
                if gain > found[0] + 1e-9:
                    found = (gain, left, right)
        return found

    parts = [(np.arange(len(y)), 0)]
    splits = [best(*parts[0])]
    while len(parts) < leaves and max(s[0] for s in splits) > 0:
        i = int(np.argmax([s[0] for s in splits]))
        _, left, right = splits.pop(i)
        _, depth = parts.pop(i)
        for rows in (left, right):
            parts.append((rows, depth + 1))
            splits.append(best(rows, depth + 1))
    out = np.zeros(len(y))
    for rows, _ in parts:
        out[rows] = -settings.rate * g[rows].sum() / h[rows].sum()
    return out, len(parts)


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(1200):
        x = [float(rng.integers(0, 12)), float(rng.integers(0, 30)), float(rng.integers(0, 2)), float(rng.normal())]
        tilt = np.sin(x[0]) + 0.1 * x[1] * (x[2] - 0.5) + rng.normal() * 0.7
        rows.append((i, ["BD", "PH", None][i % 3], x, int(tilt > 0), None if i % 11 == 0 else int(np.digitize(tilt, [-0.5, 0.8])), 2.0 if i % 5 else 1.0))
    rows += [(2000 + i, "SG", [0.0, 0.0, 0.0, 0.0], 1, 1, 1.0) for i in range(30)]
    return spark.createDataFrame(rows, "id int, market string, features array<double>, gender int, age int, w double").repartition(4).cache()


@pytest.mark.parametrize("leaves, depth", [(2, 7), (5, 7), (6, 3), (300, 3), (11, 7)])
def test_one_tree_against_all_thresholds(people, leaves, depth):
    settings = Settings(rounds=1, leaves=leaves, depth=depth, least_rows=10)
    three = people.withColumn("three", F.slice("features", 1, 3))
    model = next(m for m in fit_trees(three, "three", {"gender": 2}, settings=settings) if m.market == "BD")
    mine = [r for r in people.collect() if r.market == "BD"]
    x = np.array([r.features[:3] for r in mine])
    y = np.array([r.gender for r in mine])
    base = np.log(y.mean() / (1 - y.mean()))
    assert abs(model.base[0] - base) < 1e-12
    value, count = by_hand(x, y, base, settings, leaves)
    assert model.trees[0][0].leaves() == count <= leaves
    assert np.abs(model.margins(model.binned(x))[:, 0] - base - value).max() < 1e-9


def test_both_ways_give_the_same_trees(people, monkeypatch):
    settings = Settings(rounds=3, leaves=9, depth=4)
    kinds = {"gender": 2, "age": 3}
    here = fit_trees(people, "features", kinds, weight="w", settings=settings)
    monkeypatch.setattr(trees, "IN_ONE_TASK", 0)
    spread = fit_trees(people.repartition(7), "features", kinds, weight="w", settings=settings)
    assert [(m.market, m.kind) for m in here] == [("BD", "age"), ("BD", "gender"), ("PH", "age"), ("PH", "gender")]
    assert [m.trees for m in here] == [m.trees for m in spread]
    assert all(t.leaves() <= 9 for m in here for round_ in m.trees for t in round_)
    assert all(len(round_) == (3 if m.kind == "age" else 1) for m in here for round_ in m.trees)


def test_rounds_lower_the_loss_and_scores(people):
    models = fit_trees(people, "features", {"gender": 2, "age": 3}, settings=Settings(rounds=25, leaves=20))
    scored = score_trees(people, models, "features").collect()
    assert len(scored) == 2 * people.where("market in ('BD', 'PH')").count()
    assert all(abs(sum(r.probabilities) - 1) < 1e-9 and r.score == max(r.probabilities) for r in scored)
    for kind in ("gender", "age"):
        known = [r for r in scored if r.model_type == kind and r[kind] is not None]
        first = np.bincount([r[kind] for r in known]).max() / len(known)
        assert np.mean([r.prediction == r[kind] for r in known]) > first + 0.1


def test_missing_values_and_empty(spark):
    rows = [("A", [float(i % 7) if i % 3 else None], int(i % 3 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "market string, f array<double>, y int")
    model = fit_trees(df, "f", {"y": 2}, settings=Settings(rounds=1))[0]
    found = score_trees(df, [model], "f").collect()
    assert {(r.f[0] is None, r.prediction) for r in found} <= {(True, 1.0), (True, 0.0), (False, 0.0)}
    assert model.trees[0][0].leaves() > 1
    assert fit_trees(df.limit(0), "f", {"y": 2}) == []
    assert score_trees(df, [], "f").collect() == []


def test_few_bins(people):
    models = fit_trees(people, "features", {"gender": 2}, settings=Settings(rounds=1, bins=4))
    assert all(len(e) <= 3 for m in models for e in m.edges)
