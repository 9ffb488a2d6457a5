"""Logistic regression of all markets and model types in one sequence of jobs, by grouped Newton steps."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.session import durable, small_side

#: Rows worked on at a time.
ROWS = 8192
#: The name under which the model over all markets is kept.
EVERY = "all markets"


@dataclass
class Task:
    """What is known of one model while it is fitted; weights belong to features divided by their deviation."""

    market: str | None
    kind: str
    classes: int
    rows: int
    deviation: np.ndarray
    weights: np.ndarray = field(init=False)
    step: np.ndarray = field(init=False)
    loss: float = np.inf
    rounds: int = 0
    open: bool = True

    def __post_init__(self):
        # Two classes have one row of weights, more have one each; the last column is the intercept.
        self.weights = np.zeros((self.classes if self.classes > 2 else 1, len(self.deviation) + 1))
        self.step = np.zeros_like(self.weights)

    @property
    def tried(self) -> np.ndarray:
        return self.weights + self.step


def features_of(df: DataFrame, numbers: list[str], categories: dict[str, list[str]] | None = None):
    """One array of doubles: the numbers, then an indicator for each listed value of each category."""
    shown = [F.col(c).eqNullSafe(F.lit(v)).cast("double") for c, values in (categories or {}).items() for v in values]
    return F.array(*[F.col(n).cast("double") for n in numbers], *shown)


def category_values(df: DataFrame, categories: list[str], most: int = 10_000) -> dict[str, list[str]]:
    """The values of each category, in order. A category with more than ``most`` values is refused: each becomes a feature."""
    out = {}
    for name in categories:
        values = df.select(F.col(name).cast("string")).where(F.col(name).isNotNull()).distinct().limit(most + 1).collect()
        if len(values) > most:
            raise ValueError(f"{name} has more than {most} values")
        out[name] = sorted(row[0] for row in values)
    return out


def _evaluated(x: np.ndarray, label: np.ndarray, weight: np.ndarray, task: Task) -> tuple[float, np.ndarray, np.ndarray]:
    """Sums over rows of loss, gradient and Hessian at the weights that are tried."""
    scale = np.divide(1.0, task.deviation, out=np.zeros_like(task.deviation), where=task.deviation > 0)
    x = np.column_stack((x * scale, np.ones(len(x))))
    margins = x @ task.tried.T
    if task.classes == 2:
        z = np.where(label == 1, margins[:, 0], -margins[:, 0])
        loss = float(weight @ np.logaddexp(0, -z))
        p = 0.5 * (1 + np.tanh(margins[:, 0] / 2))
        return loss, x.T @ (weight * (p - label)), (x.T * (weight * p * (1 - p))) @ x
    top = margins.max(axis=1, keepdims=True)
    p = np.exp(margins - top)
    total = p.sum(axis=1, keepdims=True)
    p /= total
    rows = np.arange(len(x))
    loss = float(weight @ (top[:, 0] + np.log(total[:, 0]) - margins[rows, label]))
    off = p.copy()
    off[rows, label] -= 1
    gradient = (off * weight[:, None]).T @ x
    width = x.shape[1]
    hessian = np.zeros((task.classes * width, task.classes * width))
    for a in range(task.classes):
        for b in range(a, task.classes):
            spread = weight * p[:, a] * ((a == b) - p[:, b])
            block = (x.T * spread) @ x
            hessian[a * width : (a + 1) * width, b * width : (b + 1) * width] = block
            hessian[b * width : (b + 1) * width, a * width : (a + 1) * width] = block.T
    return loss, gradient.ravel(), hessian


def _sums(rows: DataFrame, kinds: list[str], tasks: list[Task]) -> dict[int, tuple[float, float, np.ndarray, np.ndarray]]:
    """(weight, loss, gradient, Hessian) of every open task over all its rows, added up in each Spark task and then cell by cell."""
    by_market: dict[str | None, list[int]] = {}
    for number, task in enumerate(tasks):
        if task.open:
            by_market.setdefault(task.market, []).append(number)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = pc.list_flatten(part.column(1)).to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                weight = part.column(2).to_numpy(zero_copy_only=False)
                coded = part.column(0).dictionary_encode()
                codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
                places = {None: np.arange(part.num_rows)} | {m.as_py(): np.flatnonzero(codes == c) for c, m in enumerate(coded.dictionary)}
                for market, at in places.items():
                    for number in by_market.get(market, []):
                        task = tasks[number]
                        label = part.column(3 + kinds.index(task.kind))
                        known = at[~label.is_null().to_numpy(zero_copy_only=False)[at]]
                        if len(known):
                            y = pc.fill_null(label, 0).to_numpy(zero_copy_only=False).astype(np.int64)[known]
                            loss, gradient, hessian = _evaluated(x[known], y, weight[known], task)
                            mine = sums.setdefault(number, [0.0, 0.0, np.zeros_like(gradient), np.zeros_like(hessian)])
                            mine[0] += weight[known].sum()
                            mine[1] += loss
                            mine[2] += gradient
                            mine[3] += hessian
        for number, (weight, loss, gradient, hessian) in sums.items():
            cells = [[weight, loss], gradient.tolist(), *hessian.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(cells), pa.int32()), pa.array(range(len(cells)), pa.int32()), pa.array(cells, pa.list_(pa.float64()))],
                ["model", "line", "cells"],
            )

    spread = rows.mapInArrow(partial, "model int, line int, cells array<double>").select("model", "line", F.posexplode("cells").alias("place", "v"))
    # A row per cell of a model's matrix, whatever the number of rows.
    found = spread.groupBy("model", "line", "place").agg(F.sum("v").alias("v")).toArrow()
    model, line, place, value = (found.column(c).to_numpy() for c in ("model", "line", "place", "v"))
    out = {}
    for number in np.unique(model).tolist():
        mine = model == number
        size = int(line[mine].max()) - 1
        grid = np.zeros((size + 2, max(size, 2)))
        grid[line[mine], place[mine]] = value[mine]
        out[number] = (grid[0, 0], grid[0, 1], grid[1, :size], grid[2:, :size])
    return out


def _advance(task: Task, sums: tuple, penalty: float, tolerance: float) -> None:
    """Accept the step that was tried and set the next, or halve it if the loss rose."""
    weight, loss, gradient, hessian = sums
    tried = task.tried
    # The penalty counts coefficients, not intercepts.
    rate = np.full(tried.shape, penalty)
    rate[:, -1] = 0.0
    rate[:, :-1][:, task.deviation == 0] = 0.0
    total = loss / weight + 0.5 * float((rate * tried**2).sum())
    task.rounds += 1
    if total > task.loss + 1e-12 * max(1.0, abs(task.loss)):
        task.step = task.step / 2
        task.open = np.abs(task.step).max() > 1e-14
        return
    task.weights, task.loss = tried, total
    slope = gradient / weight + (rate * tried).ravel()
    curve = hessian / weight + np.diag(rate.ravel())
    # Directions without curvature (repeated features, one intercept too many) are left as they are.
    values, vectors = np.linalg.eigh((curve + curve.T) / 2)
    firm = values > 1e-12 * max(values.max(), 1e-300)
    task.step = -(vectors[:, firm] @ ((vectors[:, firm].T @ slope) / values[firm])).reshape(tried.shape)
    # Half of this product is what the step gains. The last step is taken unseen: it only squares an error that is small already.
    if -float(slope @ task.step.ravel()) / 2 < tolerance:
        task.weights, task.open = task.tried, False


def fit_groups(
    df: DataFrame,
    features: str,
    kinds: dict[str, int],
    market: str = "market",
    weight: str | None = None,
    penalty: float = 1e-4,
    tolerance: float = 1e-13,
    rounds: int = 60,
    every: bool = True,
) -> list[Task]:
    """A logistic model per market and kind, and one over all rows per kind, fitted together.

    ``kinds`` gives the label columns (0, 1, ...) and their number of classes.
    Each round is one job over the rows: the tasks add up loss, gradient and
    Hessian of all models at once, so a large market is spread over all tasks
    and a small one costs no job of its own; the weights of all models go out
    as one small table. Newton steps are halved while the loss would rise.

    The penalty is half the squared coefficients of features divided by their
    deviation, beside the mean loss. Constant features get coefficient 0. Rows
    without a label of a kind are left out of it, rows without a market only
    count in the model over all. A market with one class only gets no model.
    Null features are refused, as they would make every sum null.
    """
    names = list(kinds)
    one = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    whole = F.when(F.forall(features, lambda v: v.isNotNull()), F.col(features).cast("array<double>")).otherwise(F.raise_error(F.lit("a feature is null")))
    rows = durable(df.select(F.col(market).cast("string").alias("market"), whole.alias("x"), one.alias("w"), *[F.col(k).cast("int").alias(f"y{i}") for i, k in enumerate(names)]), "grouped")
    seen = [agg for i in range(len(names)) for agg in (
        F.count(f"y{i}").alias(f"n{i}"), F.avg(F.when(F.col(f"y{i}").isNotNull(), F.col("v"))).alias(f"mean{i}"),
        F.var_pop(F.when(F.col(f"y{i}").isNotNull(), F.col("v"))).alias(f"var{i}"), F.min(f"y{i}").alias(f"low{i}"), F.max(f"y{i}").alias(f"high{i}"))]
    ys = [f"y{i}" for i in range(len(names))]
    # A row per market and feature.
    spread = rows.select("market", *ys, F.posexplode("x").alias("j", "v")).groupBy("market", "j").agg(*seen).toArrow().to_pylist()
    tasks = []
    for i, kind in enumerate(names):
        groups: dict[str | None, list] = {}
        for row in spread:
            if row[f"n{i}"]:
                groups.setdefault(row["market"] or "", []).append(row)
        models = {m: [m_rows] for m, m_rows in sorted(groups.items()) if m} | ({None: list(groups.values())} if every else {})
        for name, parts in models.items():
            if not parts or min(r[f"low{i}"] for p in parts for r in p) == max(r[f"high{i}"] for p in parts for r in p):
                continue
            tables = [np.array([[r[f"n{i}"], r[f"mean{i}"], r[f"var{i}"]] for r in sorted(p, key=lambda r: r["j"])]) for p in parts]
            n = sum(t[0, 0] for t in tables)
            mean = sum(t[:, 0] * t[:, 1] for t in tables) / n
            spread_ = sum(t[:, 0] * (t[:, 2] + (t[:, 1] - mean) ** 2) for t in tables)
            deviation = np.sqrt(spread_ / max(n - 1, 1))
            deviation[deviation < 1e-12 * np.maximum(np.abs(mean), 1e-300)] = 0.0
            tasks.append(Task(name, kind, kinds[kind], int(n), deviation))
    for _ in range(rounds):
        if not any(t.open for t in tasks):
            break
        for number, sums in _sums(rows, names, tasks).items():
            _advance(tasks[number], sums, penalty, tolerance)
    return tasks


def model_table(spark: SparkSession, tasks: list[Task]) -> DataFrame:
    """A row per model: market (``EVERY`` for the one over all), model_type, a row of coefficients and an intercept per class, rows, rounds, loss.

    Two classes have the coefficients of class 1. Intercepts of more classes sum up to 0.
    """
    rows = []
    for t in tasks:
        scale = np.divide(1.0, t.deviation, out=np.zeros_like(t.deviation), where=t.deviation > 0)
        intercepts = t.weights[:, -1] - (t.weights[:, -1].mean() if t.classes > 2 else 0.0)
        rows.append((t.market or EVERY, t.kind, (t.weights[:, :-1] * scale).tolist(), intercepts.tolist(), t.rows, t.rounds, float(t.loss)))
    return spark.createDataFrame(rows, "market string, model_type string, coefficients array<array<double>>, intercepts array<double>, n_rows long, rounds int, loss double")


def score_groups(df: DataFrame, models: DataFrame, features: str, market: str = "market") -> DataFrame:
    """Every row once per model type, with ``model_type``, ``model`` (whose it is), ``probabilities``, ``prediction`` and ``score``.

    A row goes to the model of its market, or to the one over all. The models
    are one small table; all is computed by built-in functions. Columns of
    these five names are replaced.
    """
    kept = [c for c in df.columns if c not in ("model_type", "model", "probabilities", "prediction", "score")]
    held = small_side(durable(models.select(F.col("market").alias("_model"), "model_type", "coefficients", "intercepts"), "models"))
    own = held.select(F.col("_model").alias("_own"), F.col("model_type").alias("_kind"))
    kinds = sorted(row[0] for row in models.select("model_type").distinct().collect())  # age and gender, say
    each = df.withColumn("model_type", F.explode(F.array(*[F.lit(k) for k in kinds])))
    routed = each.join(own, (F.col(market) == F.col("_own")) & (F.col("model_type") == F.col("_kind")), "left")
    routed = routed.withColumn("_model", F.coalesce("_own", F.lit(EVERY))).drop("_own", "_kind")
    joined = routed.join(held, ["_model", "model_type"], "left")
    lines = F.arrays_zip("coefficients", "intercepts")
    margins = F.transform(lines, lambda m: F.aggregate(F.zip_with(F.col(features), m["coefficients"], lambda x, c: x * c), m["intercepts"], lambda total, v: total + v))
    top = F.array_max(margins)
    powers = F.transform(margins, lambda m: F.exp(m - top))
    total = F.aggregate(powers, F.lit(0.0), lambda a, b: a + b)
    one = 1 / (1 + F.exp(-margins[0]))
    probabilities = F.when(F.size(margins) == 1, F.array(1 - one, one)).otherwise(F.transform(powers, lambda p: p / total))
    scored = joined.withColumn("probabilities", probabilities).withColumn("score", F.array_max("probabilities"))
    prediction = (F.array_position("probabilities", F.col("score")) - 1).cast("double")
    return scored.select(*kept, "model_type", F.col("_model").alias("model"), "probabilities", prediction.alias("prediction"), "score")
