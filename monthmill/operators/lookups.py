"""Joins with lists, references, predictions and expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from monthmill.operators.ordered import HOT_ROWS, hot_groups, parted, same_keys
from monthmill.session import BROADCAST_BYTES, durable, measured_bytes, small_side


def lookup(df: DataFrame, values: DataFrame, on: str | list[str], how: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join a table with one that has one row per key, whatever the sizes and the skew.

    ``values`` is stored, so that it is computed once, and broadcast up to a
    measured size of ``BROADCAST_BYTES``. A larger one is joined by shuffle,
    except for the keys that hold very many rows of ``df``; see ``skewed_join``.
    """
    kept = durable(values, "lookup")
    if measured_bytes(kept) <= BROADCAST_BYTES:
        return df.join(F.broadcast(kept), on, how)
    return skewed_join(df, kept, on, how, hot_rows)


def skewed_join(df: DataFrame, values: DataFrame, on: str | list[str], how: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join by shuffle, with the entries of hot keys broadcast, so that the rows of a hot key stay where they are.

    Entries of hot keys beyond the size for a broadcast are joined by shuffle
    too, where Spark splits skewed partitions. Keys of different types hash
    differently, so they take the plain join.
    """
    keys = [on] if isinstance(on, str) else on
    if any(df.schema[k].dataType != values.schema[k].dataType for k in keys):
        return df.join(values, keys, how)
    hot = hot_groups(df, keys, hot_rows)
    if hot.isEmpty():
        return df.join(values, keys, how)
    _, hot_values = parted(values, keys, hot)
    if how == "left_semi":
        # A list may name a key more than once.
        hot_values = hot_values.select(*keys).distinct()
    cold, hot_ones = parted(df, keys, hot)
    return cold.join(values, keys, how).unionByName(hot_ones.join(small_side(durable(hot_values, "hot-values")), keys, how))


def keep_listed(df: DataFrame, listed: DataFrame, on: str | list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows whose key is in a list."""
    return lookup(df, listed, on, "left_semi", hot_rows)


def attach(df: DataFrame, reference: DataFrame, on: str | list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Every row, with the columns of its reference entry or NULL."""
    return lookup(df, reference, on, "left", hot_rows)


def with_predictions(inputs: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Every input record beside its prediction. Both have one row per key, so nothing is skewed."""
    return inputs.join(predictions, key, "left")


def missing(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """What should be there and is not."""
    return expected.join(present, keys, "left_anti")


def attach_group_values(df: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Join values of groups, one row each, to the rows of the groups; NULL is a key like others.

    ``values`` must be cheap to read (stored, or a file). It is broadcast up to a
    measured size of ``BROADCAST_BYTES``, which also spares a shuffle by a hot
    key; beyond that Spark joins by shuffle and splits skewed partitions.
    """
    renamed = values.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], *[c for c in values.columns if c not in keys]
    )
    if measured_bytes(values) <= BROADCAST_BYTES:
        renamed = F.broadcast(renamed)
    on = same_keys(df, renamed, [(k, f"_of_{k}") for k in keys])
    return df.join(renamed, on, "left").drop(*[f"_of_{k}" for k in keys])
