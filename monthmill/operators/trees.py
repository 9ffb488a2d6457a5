"""Boosted trees grown leaf by leaf, for all markets and model types together.

MLlib's trees are limited by depth alone. These also stop at a number of
leaves, of which always the best is split next.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from monthmill.session import durable

# Parameters of the boosted variant.
MAX_BIN = 50
MAX_DEPTH = 7
NUM_LEAVES = 300

#: A market with so many rows at most is fitted in one task; larger ones are spread over all tasks. Both ways give the same trees.
IN_ONE_TASK = 200_000
#: Rows worked on at a time.
ROWS = 16384
#: Gradients are whole multiples of 1 / UNIT, so that their sums do not depend on any order.
UNIT = float(1 << 20)


@dataclass
class Settings:
    rounds: int = 20
    leaves: int = NUM_LEAVES
    depth: int = MAX_DEPTH
    bins: int = MAX_BIN
    rate: float = 0.1
    least_rows: int = 20
    penalty: float = 0.0


@dataclass
class Tree:
    """Nodes by number; node 0 is the root. A leaf has feature -1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row of binned features."""
        feature, cut, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = feature[node] >= 0
            if not inner.any():
                return node
            at, here = rows[inner], node[inner]
            node[at] = left[here] + (bins[at, feature[here]] > cut[here])

    def leaves(self) -> int:
        return sum(f < 0 for f in self.feature)


@dataclass
class Boosted:
    """One model: trees of every class (one class for two), round by round."""

    market: str
    kind: str
    classes: int
    base: np.ndarray
    edges: list[np.ndarray]
    trees: list[list[Tree]] = field(default_factory=list)

    def binned(self, x: np.ndarray) -> np.ndarray:
        """Bin b holds the values above edge b - 1 and up to edge b; a missing value counts as the greatest."""
        return np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)]).astype(np.uint8) if self.edges else np.zeros((len(x), 0), np.uint8)

    def margins(self, bins: np.ndarray) -> np.ndarray:
        out = np.tile(self.base, (len(bins), 1))
        for trees in self.trees:
            for c, tree in enumerate(trees):
                out[:, c] += np.array(tree.value)[tree.leaf_of(bins)]
        return out

    def probabilities(self, bins: np.ndarray) -> np.ndarray:
        margins = self.margins(bins)
        if self.classes == 2:
            p = 0.5 * (1 + np.tanh(margins[:, 0] / 2))
            return np.column_stack((1 - p, p))
        powers = np.exp(margins - margins.max(axis=1, keepdims=True))
        return powers / powers.sum(axis=1, keepdims=True)

    def slopes(self, bins: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and Hessian of every row and class, in whole multiples of 1 / UNIT."""
        p = self.probabilities(bins)
        p = p[:, 1:] if self.classes == 2 else p
        y = label[:, None] == (np.array([1]) if self.classes == 2 else np.arange(self.classes))
        return np.rint(weight[:, None] * (p - y) * UNIT), np.rint(weight[:, None] * np.maximum(p * (1 - p), 1e-6) * UNIT)


def histogram(tree: Tree, bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, open_: np.ndarray, width: int) -> np.ndarray:
    """Sums of (rows, gradients, Hessians) by open leaf, feature and bin; ``open_`` gives each node's place among the open leaves, or -1."""
    place = open_[tree.leaf_of(bins)]
    used = place >= 0
    place, bins = place[used], bins[used]
    n, features = bins.shape
    cells = ((place[:, None] * features + np.arange(features)) * width + bins).ravel()
    size = (open_.max() + 1) * features * width
    spread = [None, np.repeat(gradient[used], features), np.repeat(hessian[used], features)]
    return np.stack([np.bincount(cells, w, size) for w in spread]).reshape(3, -1, features, width)


def best_splits(sums: np.ndarray, settings: Settings) -> list[tuple[float, int, int]]:
    """(gain, feature, bin) of the best split of each leaf; gain 0 if none is allowed. The first of equal ones counts."""
    left = np.cumsum(sums, axis=3)[..., :-1]
    total = sums.sum(axis=3, keepdims=True)
    right = total - left
    rows = (left[0] >= settings.least_rows) & (right[0] >= settings.least_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        lam = settings.penalty * UNIT
        gain = left[1] ** 2 / (left[2] + lam) + right[1] ** 2 / (right[2] + lam) - total[1] ** 2 / (total[2] + lam)
    gain = np.where(rows & np.isfinite(gain), gain, 0.0) / UNIT
    flat = gain.reshape(len(gain), -1)
    if not flat.shape[1]:
        return [(0.0, 0, 0)] * len(gain)
    at = flat.argmax(axis=1)
    return [(float(flat[i, a]), int(a) // gain.shape[2], int(a) % gain.shape[2]) for i, a in enumerate(at)]


class Growth:
    """A tree while it grows. All leaves of a level are looked at together; ``pruned`` then keeps the best-first part.

    What a leaf gains by its best split depends on its rows alone, so the tree
    that always splits the best leaf next is a part of the whole tree of the
    allowed depth. A leaf that cannot be reached any more is not opened: to
    open it, all its ancestors with the gains they have, and every leaf that
    gains more than the smallest of these, must be split before.
    """

    def __init__(self, settings: Settings):
        self.settings = settings
        self.tree = Tree()
        self.gain: dict[int, float] = {}
        self.level = [0]
        self.depth = 0

    def open_places(self) -> np.ndarray:
        out = np.full(len(self.tree.feature), -1)
        out[self.level] = np.arange(len(self.level))
        return out

    def take(self, sums: np.ndarray) -> None:
        """The histograms of this level's leaves; splits what may be split and moves on to the next level."""
        splits = best_splits(sums, self.settings)
        below = []
        for i, node in enumerate(self.level):
            total = sums[:, i, :1].sum(axis=(1, 2))
            self.tree.value[node] = self._value(total)
            gain, feature, cut = splits[i]
            if gain > 0 and self.depth < self.settings.depth:
                self.gain[node] = gain
                below.append((node, feature, cut))
        self.depth += 1
        self.level = []
        if len(self.gain) + 1 > self.settings.leaves:
            reached = self._reached()
            below = [b for b in below if b[0] in reached]
        for node, feature, cut in below:
            self.tree.feature[node], self.tree.bin[node], self.tree.left[node] = feature, cut, len(self.tree.feature)
            for _ in range(2):
                self.level.append(len(self.tree.feature))
                for column, value in ((self.tree.feature, -1), (self.tree.bin, 0), (self.tree.left, 0), (self.tree.value, 0.0)):
                    column.append(value)

    def _value(self, total: np.ndarray) -> float:
        return float(-self.settings.rate * total[1] / (total[2] + self.settings.penalty * UNIT)) if total[0] else 0.0

    def _reached(self) -> set[int]:
        """The splits of the best-first order as far as gains are known; deeper splits can only take places away."""
        queue = [(-self.gain[0], 0)] if 0 in self.gain else []
        done: set[int] = set()
        while queue and len(done) < self.settings.leaves - 1:
            _, node = heapq.heappop(queue)
            done.add(node)
            if self.tree.feature[node] >= 0:
                for child in (self.tree.left[node], self.tree.left[node] + 1):
                    if child in self.gain:
                        heapq.heappush(queue, (-self.gain[child], child))
        return done

    def finished(self) -> bool:
        return not self.level

    def pruned(self) -> Tree:
        """The tree after ``leaves`` - 1 splits, always of the leaf with the greatest gain, the first of equal ones."""
        keep = self._reached()
        out = Tree(value=[self.tree.value[0]])
        todo = [(0, 0)]
        while todo:
            old, new = todo.pop(0)
            if old not in keep or self.tree.feature[old] < 0:
                continue
            out.feature[new], out.bin[new], out.left[new] = self.tree.feature[old], self.tree.bin[old], len(out.feature)
            for child in (self.tree.left[old], self.tree.left[old] + 1):
                todo.append((child, len(out.feature)))
                for column, value in ((out.feature, -1), (out.bin, 0), (out.left, 0), (out.value, self.tree.value[child])):
                    column.append(value)
        return out


def _fit_here(model: Boosted, bins: np.ndarray, label: np.ndarray, weight: np.ndarray, settings: Settings) -> None:
    """All rounds over rows that are at hand."""
    for _ in range(settings.rounds):
        gradient, hessian = model.slopes(bins, label, weight)
        trees = []
        for c in range(gradient.shape[1]):
            growth = Growth(settings)
            while not growth.finished():
                growth.take(histogram(growth.tree, bins, gradient[:, c], hessian[:, c], growth.open_places(), settings.bins))
            trees.append(growth.pruned())
        model.trees.append(trees)


def _fit_spread(rows: DataFrame, models: list[Boosted], kinds: list[str], settings: Settings) -> None:
    """All rounds of all models over rows in many tasks: one job per level of the trees of all models and classes."""
    by_market: dict[str, list[int]] = {}
    for number, model in enumerate(models):
        by_market.setdefault(model.market, []).append(number)
    for _ in range(settings.rounds):
        growing = {(m, c): Growth(settings) for m, model in enumerate(models) for c in range(len(model.base))}
        while any(not g.finished() for g in growing.values()):
            sent = {key: (g.tree, g.open_places()) for key, g in growing.items() if not g.finished()}

            def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                sums: dict[tuple[int, int], np.ndarray] = {}
                for batch in batches:
                    for start in range(0, batch.num_rows, ROWS):
                        part = batch.slice(start, ROWS)
                        for market, at in _places(part.column(0)).items():
                            for number in by_market.get(market, []):
                                bins, label, weight = _known(part, at, models[number], kinds)
                                if not len(bins):
                                    continue
                                gradient, hessian = models[number].slopes(bins, label, weight)
                                for (m, c), (tree, open_) in sent.items():
                                    if m == number:
                                        more = histogram(tree, bins, gradient[:, c], hessian[:, c], open_, settings.bins)
                                        sums[m, c] = sums[m, c] + more if (m, c) in sums else more
                for (m, c), grid in sums.items():
                    leaves = grid.shape[1]
                    flat = grid.transpose(1, 0, 2, 3).reshape(leaves, -1).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([m] * leaves, pa.int32()), pa.array([c] * leaves, pa.int32()), pa.array(range(leaves), pa.int32()), pa.array(flat.tolist(), pa.list_(pa.int64()))],
                        ["model", "class", "leaf", "cells"],
                    )

            cells = rows.mapInArrow(partial, "model int, class int, leaf int, cells array<long>").select("model", "class", "leaf", F.posexplode("cells").alias("place", "v"))
            # A row per cell of the histograms, whatever the number of rows; sums of whole numbers are exact.
            found = cells.groupBy("model", "class", "leaf", "place").agg(F.sum("v").alias("v")).toArrow()
            model, klass, leaf, place, value = (found.column(c).to_numpy() for c in ("model", "class", "leaf", "place", "v"))
            for (m, c), (_, open_) in sent.items():
                mine = (model == m) & (klass == c)
                features = len(models[m].edges)
                grid = np.zeros((int(open_.max()) + 1, 3 * features * settings.bins))
                grid[leaf[mine], place[mine]] = value[mine]
                growing[m, c].take(grid.reshape(-1, 3, features, settings.bins).transpose(1, 0, 2, 3))
        for m, model in enumerate(models):
            model.trees.append([growing[m, c].pruned() for c in range(len(model.base))])


def _places(markets: pa.Array) -> dict[str, np.ndarray]:
    coded = markets.dictionary_encode()
    codes = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)
    return {m.as_py(): np.flatnonzero(codes == c) for c, m in enumerate(coded.dictionary)}


def _matrix(x: pa.Array, features: int) -> np.ndarray:
    return pc.list_flatten(x).to_numpy(zero_copy_only=False).astype(float).reshape(len(x), features)


def _known(part, at: np.ndarray, model: Boosted, kinds: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Binned features, labels and weights of the rows of a batch that have the model's label."""
    label = part.column(3 + kinds.index(model.kind))
    at = at[~label.is_null().to_numpy(zero_copy_only=False)[at]]
    taken = pa.array(at)
    x = _matrix(part.column(1).take(taken), len(model.edges))
    return model.binned(x), label.take(taken).to_numpy(zero_copy_only=False).astype(np.int64), part.column(2).take(taken).to_numpy(zero_copy_only=False)


def bin_edges(rows: DataFrame, bins: int) -> dict[str, list[np.ndarray]]:
    """Per market and feature at most ``bins`` - 1 edges: the values themselves if they are few, else quantiles."""
    shares = F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])
    spread = rows.where(F.col("market").isNotNull()).select("market", F.posexplode("x").alias("j", "v"))
    quantiles = spread.groupBy("market", "j").agg(F.percentile_approx("v", shares, 10_000).alias("edges"))
    # Only the first values of each feature are collected, which tells whether there are more than bins.
    distinct = spread.distinct().withColumn("nr", F.row_number().over(Window.partitionBy("market", "j").orderBy("v"))).where(F.col("nr") <= bins + 1)
    few = distinct.groupBy("market", "j").agg(F.array_sort(F.collect_list("v")).alias("values"))
    out: dict[str, list[np.ndarray]] = {}
    for row in quantiles.join(few, ["market", "j"]).orderBy("market", "j").collect():  # a row per market and feature
        found = row["values"][:-1] if len(row["values"]) <= bins else row["edges"]
        found = np.unique(np.array([v for v in found if not np.isnan(v)], float))
        out.setdefault(row.market, []).append(found)
    return out


def fit_trees(df: DataFrame, features: str, kinds: dict[str, int], market: str = "market", weight: str | None = None, settings: Settings | None = None) -> list[Boosted]:
    """Boosted trees per market and kind of label (0, 1, ...), of several classes one tree per class and round.

    Features are put into at most ``bins`` bins per market. A level of all
    trees costs one job: tasks add up rows, gradients and Hessians per leaf,
    feature and bin, and only these sums are shuffled. Of the leaves always
    the one with the greatest gain is split, until there are ``leaves`` or
    none can be split: no deeper than ``depth``, with ``least_rows`` rows on
    either side. Markets of up to ``IN_ONE_TASK`` rows are fitted in a task
    each; gradients are whole multiples of a small unit, so both ways, and
    every order of rows, give the same trees.

    Rows without market or label are passed over; a market with one class
    only gets no model. Null features count as the greatest value.
    """
    settings = settings or Settings()
    names = list(kinds)
    one = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    numbers = F.transform(F.col(features), lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    ys = [F.col(k).cast("int").alias(f"y{i}") for i, k in enumerate(names)]
    rows = durable(df.where(F.col(market).isNotNull()).select(F.col(market).cast("string").alias("market"), numbers.alias("x"), one.alias("w"), *ys), "trees")
    edges = bin_edges(rows, settings.bins)
    sizes = [F.count("*").alias("n")]
    for i, kind in enumerate(names):
        sizes += [F.coalesce(F.sum(F.when(F.col(f"y{i}") == c, F.col("w"))), F.lit(0.0)).alias(f"w{i}_{c}") for c in range(kinds[kind])]
    models, small = [], []
    for row in rows.groupBy("market").agg(*sizes).orderBy("market").collect():  # a row per market
        for i, kind in enumerate(names):
            mass = np.array([row[f"w{i}_{c}"] for c in range(kinds[kind])], float)
            if (mass > 0).sum() < 2:
                continue
            share = np.maximum(mass / mass.sum(), 1e-12)
            base = np.array([np.log(share[1] / share[0])]) if kinds[kind] == 2 else np.log(share)
            model = Boosted(row.market, kind, kinds[kind], base, edges.get(row.market, []))
            (small if row.n <= IN_ONE_TASK else models).append(model)
    if models:
        _fit_spread(rows, models, names, settings)
    if small:
        _fit_in_tasks(rows, small, names, settings)
    return sorted(models + small, key=lambda m: (m.market, m.kind))


def _fit_in_tasks(rows: DataFrame, models: list[Boosted], kinds: list[str], settings: Settings) -> None:
    """A task per market, each with at most ``IN_ONE_TASK`` rows; the finished trees come back as text."""
    by_market: dict[str, list[int]] = {}
    for number, model in enumerate(models):
        by_market.setdefault(model.market, []).append(number)

    def fitted(key: tuple, table: pa.Table) -> pa.Table:
        part = table.combine_chunks().to_batches()[0]
        numbers, lines = [], []
        for number in by_market[key[0].as_py()]:
            bins, label, weight = _known(part, np.arange(part.num_rows), models[number], kinds)
            _fit_here(models[number], bins, label, weight, settings)
            numbers.append(number)
            lines.append([[[t.feature, t.bin, t.left, t.value] for t in trees] for trees in models[number].trees])
        return pa.table({"model": pa.array(numbers, pa.int32()), "trees": [json.dumps(line) for line in lines]})

    mine = rows.where(F.col("market").isin(list(by_market)))
    for row in mine.groupBy("market").applyInArrow(fitted, "model int, trees string").collect():  # a row per model
        models[row.model].trees = [[Tree(*columns) for columns in trees] for trees in json.loads(row.trees)]


def score_trees(df: DataFrame, models: list[Boosted], features: str, market: str = "market") -> DataFrame:
    """Rows of markets with a model, once per model of theirs: ``model_type``, ``probabilities``, ``prediction`` and ``score`` beside the columns of ``df``.

    The trees are broadcast; their size is bounded by rounds, classes and leaves. Columns of these four names are replaced.
    """
    kept = [c for c in df.columns if c not in ("model_type", "probabilities", "prediction", "score", "_number")]
    numbers = F.transform(F.col(features), lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    listed: dict[str, list[int]] = {}
    for number, model in enumerate(models):
        listed.setdefault(model.market, []).append(number)
    which = F.create_map(*[x for m, ns in listed.items() for x in (F.lit(m), F.array(*[F.lit(n) for n in ns]))]) if listed else F.lit(None).cast("map<string,array<int>>")
    each = df.select(*kept, F.explode(which[F.col(market).cast("string")]).alias("_number"), numbers.alias("_x"))
    shared = df.sparkSession.sparkContext.broadcast(models)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(len(kept)).to_numpy(zero_copy_only=False)
            chance: list = [None] * batch.num_rows
            for n in np.unique(number).tolist():
                at = np.flatnonzero(number == n)
                model = shared.value[n]
                p = model.probabilities(model.binned(_matrix(batch.column(len(kept) + 1).take(pa.array(at)), len(model.edges))))
                for row, line in zip(at.tolist(), p.tolist()):
                    chance[row] = line
            kinds = [shared.value[n].kind for n in number.tolist()]
            top = [float(np.argmax(p)) for p in chance]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array(kinds, pa.string()), pa.array(chance, pa.list_(pa.float64())), pa.array(top, pa.float64()), pa.array([max(p) for p in chance], pa.float64())],
                [*kept, "model_type", "probabilities", "prediction", "score"],
            )

    shape = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*kept).schema]
    return each.mapInArrow(scored, ", ".join([*shape, "model_type string", "probabilities array<double>", "prediction double", "score double"]))
