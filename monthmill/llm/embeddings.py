"""Near duplicates of vectors by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.graph import components, local_components
from monthmill.llm.tables import share, stored

#: Vectors from which the principal dimensions are taken. Any rotation gives the same links.
SAMPLE = 10_000
#: Leading principal dimensions that make the grid.
LEADING = 16
#: Vectors per interval of the order, and the most intervals: their boxes, 256 bytes each, are sent to all executors.
BLOCK = 4096
MOST_BLOCKS = 1 << 17
#: Intervals of ``BLOCK`` vectors whose vectors visit another one at a time.
VISITS = 8
#: Rows sent on at a time.
_ROWS = 1 << 14
#: An interval of so many vectors is compared directly.
DIRECT = 512


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: it has components, all are finite, and one is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _units(vectors: pa.Array, dimension: int) -> np.ndarray:
    values = vectors.flatten().to_numpy().reshape(-1, dimension)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _by_dimension(vectors: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Unit vectors by their number of components: (dimension, rows, units)."""
    sizes = np.diff(vectors.offsets.to_numpy())
    for dimension in np.unique(sizes):
        rows = np.flatnonzero(sizes == dimension)
        yield int(dimension), rows, _units(vectors.take(pa.array(rows)), int(dimension))


def _rotations(sample: pa.Array, reach: float) -> dict[int, np.ndarray]:
    out = {}
    for dimension, _, units in _by_dimension(sample):
        _, axes = np.linalg.eigh(np.cov(units, rowvar=False).reshape(dimension, dimension)) if len(units) > 1 else (None, np.eye(dimension))
        out[dimension] = axes[:, ::-1][:, :LEADING]
    return out


def _rotate(units: np.ndarray, rotations: dict[int, np.ndarray]) -> np.ndarray:
    """Leading principal coordinates, filled up with zeros."""
    dimension = units.shape[1]
    axes = rotations.get(dimension, np.eye(dimension)[:, :LEADING])
    out = np.zeros((len(units), LEADING))
    out[:, : axes.shape[1]] = units @ axes
    return out


def _box_gap(low: np.ndarray, high: np.ndarray, other_low: np.ndarray, other_high: np.ndarray) -> np.ndarray:
    """The least possible distance of points in two boxes."""
    return np.sqrt((np.maximum(0, np.maximum(low - other_high, other_low - high)) ** 2).sum(axis=-1))


def _close_leaves(low: np.ndarray, high: np.ndarray, low2: np.ndarray, high2: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Pairs of leaves of two sequences, found by halving both and leaving out intervals whose boxes are too far apart."""
    todo = [(0, len(low), 0, len(low2))]
    while todo:
        a, b, c, d = todo.pop()
        if a >= b or c >= d or _box_gap(low[a:b].min(axis=0), high[a:b].max(axis=0), low2[c:d].min(axis=0), high2[c:d].max(axis=0)) > reach:
            continue
        if b - a == 1 and d - c == 1:
            yield a, c
        elif b - a >= d - c:
            todo += [(a, (a + b) // 2, c, d), ((a + b) // 2, b, c, d)]
        else:
            todo += [(a, b, c, (c + d) // 2), (a, b, (c + d) // 2, d)]


def _leaves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.arange(0, len(points), DIRECT)
    if not len(starts):
        return starts, np.zeros((0, LEADING)), np.zeros((0, LEADING))
    return starts, np.minimum.reduceat(points, starts), np.maximum.reduceat(points, starts)


def join_interval(units: np.ndarray, points: np.ndarray, weights: np.ndarray, homes: int, least: float, own: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links between the first ``homes`` vectors and the others, and among the first if ``own``.

    Returns the weight of each vector's partners and the smallest vector of its component.
    """
    reach = np.sqrt(2 - 2 * least) + 1e-9
    n = len(units)
    partners, root = np.zeros(n, np.int64), np.arange(n)
    starts, low, high = _leaves(points[:homes])
    guests, low2, high2 = _leaves(points[homes:])
    pairs = [(starts[a], homes + guests[b], n) for a, b in _close_leaves(low, high, low2, high2, reach)]
    if own:
        pairs += [(starts[a], starts[b], homes) for a, b in _close_leaves(low, high, low, high, reach) if a <= b]
    for a, b, end in pairs:
        i, j = np.nonzero(units[a : min(a + DIRECT, homes)] @ units[b : min(b + DIRECT, end)].T >= least)
        i, j = i + a, j + b
        if a == b:
            i, j = i[i < j], j[i < j]
        if len(i):
            partners += np.bincount(i, weights[j], n).astype(np.int64) + np.bincount(j, weights[i], n).astype(np.int64)
            i, j = root[i], root[j]
            apart = i != j
            if apart.any():
                root = local_components(n, np.concatenate((np.arange(n), i[apart])), np.concatenate((root, j[apart])))
    return partners, root


def near_duplicates(vectors: DataFrame, least: float = 0.95, *, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per vector: key, n_links, component_id, kept, with links at a cosine of ``least`` or more.

    Equal vectors become one with a weight. The others are sorted by the cells,
    of the links' reach, in which their leading principal coordinates lie; the
    order is cut into intervals of ``BLOCK``, or longer ones beyond
    ``MOST_BLOCKS``. Intervals whose boxes are out of reach of each other never
    meet; a vector visits an earlier interval only if it can be within reach of
    the interval's box, and there intervals are halved and left out in the same
    way before cosines are taken, in double precision. An interval sends back a number of links per vector
    and a star per group, never the pairs.

    Vectors that are null, empty, zero or not finite, and vectors of different
    lengths, are never linked. Null keys are passed over when the smallest is
    taken. Rows that repeat a key are vectors of their own. An empty table gives
    an empty table. Other columns are not read.
    """
    spark = vectors.sparkSession
    reach = float(np.sqrt(2 - 2 * least) + 1e-9)
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")).withColumn("ok", usable(F.col("v")))
    distinct = rows.filter("ok").groupBy("v").agg(F.count("*").alias("weight"), F.min("key").alias("first"))
    single = stored(distinct.select(F.monotonically_increasing_id().alias("id"), "v", "weight", "first"), "vectors")
    n = single.count()
    width = max(BLOCK, -(-n // MOST_BLOCKS))  # vectors per interval
    visits = max(1, VISITS * BLOCK // width)  # intervals that visit at a time
    sample = single.filter(share("id") < SAMPLE / max(n, 1)).select("v").toArrow().column("v").combine_chunks()
    rotations = spark.sparkContext.broadcast(_rotations(sample, reach) if len(sample) else {})

    def cells(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keys: list[bytes] = [b""] * part.num_rows
            for dimension, at, units in _by_dimension(part.column(1)):
                grid = np.column_stack((np.full((len(at), 1), dimension), np.floor(_rotate(units, rotations.value) / reach) + (1 << 20))).astype(">u4")
                for row, cell in zip(at, grid):
                    keys[row] = cell.tobytes()
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())], names=["id", "v", "weight", "cell"])

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for part in parts:
            place = pa.array(np.arange(done, done + part.num_rows))
            done += part.num_rows
            yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(np.full(part.num_rows, task, np.int32)), place], names=["id", "v", "weight", "task", "place"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = single.select("id", "v", "weight").mapInArrow(cells, "id long, v array<double>, weight long, cell binary").repartitionByRange(tasks, "cell", "id").sortWithinPartitions("cell", "id")
    numbered = stored(ordered.mapInArrow(number, "id long, v array<double>, weight long, task int, place long"), "order")
    starts, rank = {}, 0
    for row in numbered.groupBy("task").count().orderBy("task").collect():  # one row per partition
        starts[row.task] = rank
        rank += row["count"]
    offsets = spark.sparkContext.broadcast(starts)

    def rank_of(part: pa.RecordBatch) -> np.ndarray:
        first = np.array([offsets.value[t] for t in part.column(3).to_numpy()], np.int64)
        return first + part.column(4).to_numpy()

    def corners(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            block = rank_of(part) // width
            for dimension, at, units in _by_dimension(part.column(1)):
                points = _rotate(units, rotations.value)
                for b in np.unique(block[at]):
                    mine = points[block[at] == b]
                    yield pa.RecordBatch.from_arrays([pa.array([int(b)]), pa.array([dimension], pa.int32()), pa.array([mine.min(axis=0).tolist()]), pa.array([mine.max(axis=0).tolist()])], names=["block", "dimension", "low", "high"])

    least_of = [F.min(F.col("low")[k]).alias(f"l{k}") for k in range(LEADING)]
    most_of = [F.max(F.col("high")[k]).alias(f"h{k}") for k in range(LEADING)]
    boxes = numbered.mapInArrow(corners, "block long, dimension int, low array<double>, high array<double>").groupBy("block", "dimension").agg(*least_of, *most_of).orderBy("block", "dimension").collect()
    box = {}
    for size in {r.dimension for r in boxes}:
        mine = [r for r in boxes if r.dimension == size]
        box[size] = np.array([r.block for r in mine]), np.array([r[2 : 2 + LEADING] for r in mine], float), np.array([r[2 + LEADING :] for r in mine], float)
    sent = spark.sparkContext.broadcast(box)

    def moves(part: pa.RecordBatch, ranks: np.ndarray) -> Iterator[tuple[np.ndarray, int, int]]:
        """(rows, home, visit): which rows of a batch go to which meetings."""
        for dimension, at, units in _by_dimension(part.column(1)):
            points, own = _rotate(units, rotations.value), ranks[at] // width
            blocks, low, high = sent.value[dimension]
            for block in np.unique(own):
                rows, spots, k = at[own == block], points[own == block], np.searchsorted(blocks, block)
                close = _box_gap(low, high, low[k], high[k]) <= reach
                for home in np.flatnonzero(close[:k]):
                    yield rows[_box_gap(spots, spots, low[home], high[home]) <= reach], blocks[home], block // visits
                # A home meets its visitors a few intervals at a time, so that a task's memory is bounded.
                for visit in np.unique(blocks[k:][close[k:]] // visits):
                    yield rows, block, visit

    def visit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ranks, held, size = rank_of(part), [], 0

            def send() -> pa.RecordBatch:
                rows, home, group = (np.concatenate([np.asarray(m[k]) for m in held]) for k in range(3))
                return pa.RecordBatch.from_arrays([pa.array(home), pa.array(group), pa.array(ranks[rows]), *part.take(pa.array(rows)).columns[:3]], names=["home", "visit", "rank", "id", "v", "weight"])

            for rows, home, group in moves(part, ranks):
                held.append((rows, np.full(len(rows), home, np.int64), np.full(len(rows), group, np.int64)))
                size += len(rows)
                if size >= _ROWS:
                    yield send()
                    held, size = [], 0
            if size:
                yield send()

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("rank")
        home, visit_no = group.column("home")[0].as_py(), group.column("visit")[0].as_py()
        ids, weights = group.column("id").to_numpy(), group.column("weight").to_numpy()
        out = []
        for _, at, units in _by_dimension(group.column("v").combine_chunks()):
            here = int((group.column("rank").to_numpy()[at] // width == home).sum())
            partners, root = join_interval(units, _rotate(units, rotations.value), weights[at], here, least, home // visits == visit_no)
            linked = np.flatnonzero(partners)
            out.append((ids[at[linked]], ids[at[root[linked]]], partners[linked]))
        a, b, w = (np.concatenate([x[k] for x in out] or [np.zeros(0, np.int64)]) for k in range(3))
        return pa.table({"a": a, "b": b, "links": w})

    meetings = numbered.mapInArrow(visit, "home long, visit long, rank long, id long, v array<double>, weight long").repartition(tasks, "home", "visit")
    found = stored(meetings.groupBy("home", "visit").applyInArrow(join, "a long, b long, links long"), "links")
    links = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "id")
    group = components(found.select("a", "b")).withColumnRenamed("node", "id")
    classes = single.join(links, "id", "left").join(group, "id", "left").select("v", "first", "weight", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    classes = stored(classes, "classes")
    firsts = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = classes.join(firsts, "component").select("v", "n_links", "component_id")
    linked = rows.filter("ok").join(named, "v").select("key", "n_links", "component_id")
    alone = rows.filter("not ok").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))
    every = linked.union(alone)
    return every.select(F.col("key").alias(key), "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
