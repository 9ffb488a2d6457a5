"""Accuracy, overall and per score decile, and the gate on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthmill.operators.gates import verdict
from monthmill.operators.lookups import attach_group_values
from monthmill.operators.ordered import HOT_ROWS, row_numbers
from monthmill.session import durable

ACCURACY_GATE = 0.9
_BINS = 4096


def accuracy_of(prediction: Column, label: Column) -> Column:
    """The share of rows whose prediction equals the label; a missing one counts as wrong."""
    return F.avg(F.when(prediction == label, 1.0).otherwise(0.0))


def accuracy(df: DataFrame, keys: list[str], prediction: str, label: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"), accuracy_of(F.col(prediction), F.col(label)).alias("accuracy")
    )


def quality_gate(df: DataFrame, keys: list[str], prediction: str, label: str, threshold: float = ACCURACY_GATE) -> DataFrame:
    """Accuracy and whether it reaches the threshold."""
    measured = accuracy(df, keys, prediction, label)
    return measured.withColumn("branch", verdict(F.col("accuracy"), threshold))


def tile_of(rank: Column, size: Column, tiles: int) -> Column:
    """The tile of a 1-based rank when ``size`` rows are dealt into tiles that differ by one row at most."""
    base, wider = F.floor(size / tiles), size % tiles
    in_wider = wider * (base + 1)
    early = F.floor((rank - 1) / (base + 1)) + 1
    late = wider + F.floor((rank - 1 - in_wider) / F.greatest(base, F.lit(1))) + 1
    return F.when(rank <= in_wider, early).otherwise(late).cast("int")


def with_tiles(
    df: DataFrame,
    keys: list[str],
    score: str,
    row_id: str,
    name: str = "decile",
    tiles: int = 10,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the tile of each row within its group, by score from high to low, then by id.

    Groups are few and large, so they are not sorted. The range of scores of a
    group is cut into bins; the row counts of the bins give the ranks at which
    each bin begins and ends. All rows of a bin that lies within one tile get
    it at once. Only bins across a tile border, at most ``tiles - 1`` per group,
    are ranked row by row. Missing scores come last, NaN first.
    """
    number = F.col(score).cast("double")
    finite = F.when(~F.isnan(number), number)
    ranges = durable(
        df.groupBy(*keys).agg(F.min(finite).alias("_low"), F.max(finite).alias("_high"), F.count("*").alias("_size"))
    )
    width = F.col("_high") - F.col("_low")
    inside = F.least(F.floor((F.col("_high") - number) / width * _BINS), F.lit(_BINS - 1))
    bin_ = (
        F.when(number.isNull(), _BINS)
        .when(F.isnan(number), -1)
        .when((width > 0) & (width < float("inf")), inside)
        .otherwise(0)
    )
    binned = attach_group_values(df, ranges, keys).withColumn("_bin", bin_.cast("int"))
    bins = binned.groupBy(*keys, "_bin").agg(F.count("*").alias("_n"), F.max("_size").alias("_size"))
    so_far = Window.partitionBy(*keys).orderBy("_bin")
    spans = (
        bins.withColumn("_end", F.sum("_n").over(so_far))
        .withColumn("_start", F.col("_end") - F.col("_n"))
        .withColumn("_tile", tile_of(F.col("_start") + 1, F.col("_size"), tiles))
        .withColumn("_split", F.col("_tile") != tile_of(F.col("_end"), F.col("_size"), tiles))
    )
    # A bin goes on with the tile of the bin before it unless it starts a step; a group has two steps per tile at most.
    before = F.lag(F.struct("_tile", "_split")).over(so_far)
    starts = F.col("_split") | before.isNull() | before["_split"] | (before["_tile"] != F.col("_tile"))
    step = F.when(starts, F.struct("_bin", "_tile", "_split", "_start"))
    steps = spans.withColumn("_step", step).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_step")).alias("_steps"), F.max(F.when(F.col("_split"), F.col("_n"))).alias("_most")
    )
    steps = durable(steps, "tile-steps")
    own = F.element_at(F.filter("_steps", lambda s: s["_bin"] <= F.col("_bin")), -1)
    placed = attach_group_values(binned.drop("_low", "_high"), steps.drop("_most"), keys).withColumn("_own", own)
    placed = placed.withColumn("_split", F.col("_own._split"))

    order = [F.desc(score), F.asc(row_id)]
    split = placed.where("_split")
    if steps.where(F.col("_most") > hot_rows).isEmpty():
        within = Window.partitionBy(*keys, "_bin").orderBy(*order)
        ranked = split.withColumn("_rank", F.row_number().over(within))
    else:
        ranked = row_numbers(split, [*keys, "_bin"], order, "_rank", hot_rows)
    border_tile = tile_of(F.col("_own._start") + F.col("_rank"), F.col("_size"), tiles)
    whole = placed.where(~F.col("_split")).withColumn(name, F.col("_own._tile"))
    ranked = ranked.withColumn(name, border_tile)
    return whole.select(*df.columns, name).unionByName(ranked.select(*df.columns, name))


def decile_accuracy(
    df: DataFrame, keys: list[str], score: str, row_id: str, prediction: str, label: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows and accuracy per group and score decile; decile 1 holds the highest scores.

    The needed columns are stored first, so a model that gives the scores runs once.
    """
    needed = list(dict.fromkeys([*keys, score, row_id, prediction, label]))
    tiled = with_tiles(durable(df.select(*needed), "scored"), keys, score, row_id, hot_rows=hot_rows)
    return accuracy(tiled, [*keys, "decile"], prediction, label)
