"""Row numbers, previous rows and forward fill within groups of any size.

A window puts a whole group into one task. Here only groups up to
``HOT_ROWS`` rows are left to a plain window. The rows of larger groups are
range-partitioned by key and order, so that one group spreads over many
chunks; each chunk is worked on alone, and a small table with one row per
group and chunk carries counts or values from chunk to chunk.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from monthmill.session import durable, small_side

HOT_ROWS = 5_000_000
CHUNK_ROWS = 2_000_000

_CHUNK = "_chunk"


def row_numbers(
    df: DataFrame, keys: list[str], order: list[Column], name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the row number within each group. ``order`` should be free of ties."""

    def number(rows: DataFrame, *extra: str) -> DataFrame:
        window = Window.partitionBy(*keys, *extra).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(window).cast("long"))

    def number_chunks(rows: DataFrame, size: int) -> DataFrame:
        chunks = _chunks(rows, keys, order, size, hot_rows)
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            chunks.groupBy(*keys, _CHUNK)
            .agg(F.count("*").alias("_rows"))
            .select(*keys, _CHUNK, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_carried"))
        )
        numbered = _with_carried(number(chunks, _CHUNK), carried, keys)
        return numbered.withColumn(name, F.col(name) + F.col("_carried")).drop("_carried", _CHUNK)

    return _by_group_size(df, keys, hot_rows, number, number_chunks)


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    column: str,
    name: str,
    hot_rows: int = HOT_ROWS,
    known: bool = False,
) -> DataFrame:
    """Add the value that ``column`` has in the row before, NULL in the first row of a group.

    With ``known`` it is the last value before the row that is not NULL.
    """

    def before(*extra: str) -> Column:
        window = Window.partitionBy(*keys, *extra).orderBy(*order)
        if not known:
            return F.lag(column).over(window)
        return F.last(column, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))

    def previous(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, before())

    def previous_in_chunks(rows: DataFrame, size: int) -> DataFrame:
        chunks = _chunks(rows, keys, order, size, hot_rows)
        at = F.struct(*order)
        if known:
            at = F.when(F.col(column).isNotNull(), at)
        # The outer struct tells a chunk without a value from one whose last value is NULL.
        lasts = chunks.groupBy(*keys, _CHUNK).agg(F.max_by(F.struct(column), at).alias("_last"))
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        last = F.last("_last", ignorenulls=True).over(earlier)
        carried = lasts.select(*keys, _CHUNK, last[column].alias("_carried"))
        inside = Window.partitionBy(*keys, _CHUNK).orderBy(*order)
        local = chunks.withColumn("_first", F.row_number().over(inside) == 1).withColumn(name, before(_CHUNK))
        missing = F.col(name).isNull() if known else F.col("_first")
        value = F.when(missing, F.col("_carried")).otherwise(F.col(name))
        return _with_carried(local, carried, keys).withColumn(name, value).drop("_carried", "_first", _CHUNK)

    return _by_group_size(df, keys, hot_rows, previous, previous_in_chunks)


def forward_fill(
    df: DataFrame, keys: list[str], order: list[str], column: str, name: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the last value of ``column`` that is not NULL, up to and with the row itself."""

    def fill(rows: DataFrame, *extra: str) -> DataFrame:
        so_far = (
            Window.partitionBy(*keys, *extra).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return rows.withColumn(name, F.last(column, ignorenulls=True).over(so_far))

    def fill_chunks(rows: DataFrame, size: int) -> DataFrame:
        chunks = _chunks(rows, keys, order, size, hot_rows)
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        known = F.when(F.col(column).isNotNull(), F.struct(*order))
        carried = (
            chunks.groupBy(*keys, _CHUNK)
            .agg(F.max_by(column, known).alias("_last"))
            .select(*keys, _CHUNK, F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
        )
        filled = _with_carried(fill(chunks, _CHUNK), carried, keys)
        return filled.withColumn(name, F.coalesce(name, "_carried")).drop("_carried", _CHUNK)

    return _by_group_size(df, keys, hot_rows, fill, fill_chunks)


def hot_groups(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """``tag, n``: hash of the keys and number of rows of all groups above ``hot_rows``, stored.

    The counts are pre-aggregated before their shuffle. Keys that share a
    hash are counted together, which only makes them hot a little sooner.
    """
    counts = df.groupBy(F.xxhash64(*keys).alias("tag")).agg(F.count("*").alias("n"))
    return durable(counts.where(F.col("n") > hot_rows), "hot-groups")


def parted(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all other groups, and those of the hot ones."""
    tags = small_side(hot.select(F.col("tag").alias("_tag")))
    tagged = df.withColumn("_tag", F.xxhash64(*keys))
    return tagged.join(tags, "_tag", "left_anti").drop("_tag"), tagged.join(tags, "_tag", "left_semi").drop("_tag")


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of keys in which NULL equals NULL."""
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _by_group_size(
    df: DataFrame,
    keys: list[str],
    hot_rows: int,
    plain: Callable[[DataFrame], DataFrame],
    chunked: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    hot = hot_groups(df, keys, hot_rows)
    size = hot.agg(F.sum("n")).first()[0]
    if not size:
        return plain(df)
    cold_rows, hot_ones = parted(df, keys, hot)
    return plain(cold_rows).unionByName(chunked(hot_ones, size))


def _chunks(df: DataFrame, keys: list[str], order: list, size: int, hot_rows: int) -> DataFrame:
    """Number the range partitions. They are stored, since a second run could cut elsewhere."""
    parts = max(2, math.ceil(size / min(CHUNK_ROWS, hot_rows)))
    return durable(df.repartitionByRange(parts, *keys, *order).withColumn(_CHUNK, F.spark_partition_id()), "chunks")


def _with_carried(chunks: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """Join the carried values, about one row per chunk and hot key."""
    renamed = carried.select(*[F.col(k).alias(f"_of_{k}") for k in [*keys, _CHUNK]], "_carried")
    renamed = durable(renamed, "carried")
    on = same_keys(chunks, renamed, [(k, f"_of_{k}") for k in [*keys, _CHUNK]])
    return chunks.join(small_side(renamed), on, "left").drop(*[f"_of_{k}" for k in [*keys, _CHUNK]])
