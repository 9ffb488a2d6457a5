"""One day of a table."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F, types as T

USER_COLUMNS = ["id", "email", "phone", "isKycApproved", "userType"]


def first_part(column: Column, separator: str = " ") -> Column:
    """The text before the first separator (a regular expression)."""
    return F.split(column, separator).getItem(0)


def between_days(df: DataFrame, column: str, first: str, after: str) -> Column:
    """``first <= column < after`` with both bounds in the column's own type, so they reach the scan."""
    kind = df.schema[column].dataType
    return (F.col(column) >= F.lit(first).cast(kind)) & (F.col(column) < F.lit(after).cast(kind))


def on_day(df: DataFrame, column: str, day: str) -> Column:
    """Whether the text of ``column`` up to its first blank is ``day`` (yyyy-mm-dd).

    Times and dates are compared as a range, which is pushed down. Text keeps
    the split: a time written with a ``T`` has no blank and never matches.
    """
    date = datetime.date.fromisoformat(day)
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return between_days(df, column, day, str(date + datetime.timedelta(days=1)))
    return first_part(F.col(column)) == day


def day_slice(df: DataFrame, day: str, created: str = "createdAt", columns: list[str] | None = None) -> DataFrame:
    """The rows created on ``day`` with the given columns and the day as ``date``."""
    kept = USER_COLUMNS if columns is None else columns
    return (
        df.where(on_day(df, created, day))
        .withColumn("date", first_part(F.col(created).cast("string")))
        .select(*kept, "date")
    )


def first_row(df: DataFrame, *order: str | Column) -> DataFrame:
    """The first row in a stated order."""
    return df.orderBy(*order).limit(1)
