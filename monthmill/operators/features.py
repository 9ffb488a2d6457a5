"""Per-user activity: days, months, periods, carriers and next month's label."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from monthmill.functions.dates import month_of, months_between_starts
from monthmill.operators.lookups import skewed_join
from monthmill.operators.ordered import HOT_ROWS, with_previous
from monthmill.operators.slices import between_days

PERIODS = 6


def month_shift(month: datetime.date, months: int) -> datetime.date:
    place = month.year * 12 + month.month - 1 + months
    return datetime.date(place // 12, place % 12 + 1, 1)


def active_days(moment: Column, condition: Column | None = None) -> Column:
    """Distinct days of one month, as an aggregate over a mask with one bit per day.

    The mask is merged in the map tasks like a sum, where a distinct count
    would need a shuffle of its own.
    """
    bit = F.call_function("shiftleft", F.lit(1), F.dayofmonth(moment) - 1)
    mask = F.bit_or(bit if condition is None else F.when(condition, bit))
    return F.coalesce(F.bit_count(mask), F.lit(0)).cast("long")


def daily_totals(df: DataFrame, moment: str, keys: list[str], value: str) -> DataFrame:
    """Number of rows and sum of values per day and key."""
    return df.groupBy(F.to_date(moment).alias("day"), *keys).agg(
        F.count("*").alias("n"), F.sum(value).alias("total")
    )


def monthly_activity(df: DataFrame, user: str, moment: str) -> DataFrame:
    """Requests and distinct active days per user and month."""
    return df.groupBy(user, month_of(F.col(moment)).alias("month")).agg(
        F.count("*").alias("brq_count"), active_days(F.col(moment)).alias("num_days")
    )


def in_periods(df: DataFrame, moment: str, month: datetime.date, periods: int = PERIODS) -> DataFrame:
    """The rows of the reference month and the ``periods - 1`` months before it."""
    first, after = month_shift(month, 1 - periods), month_shift(month, 1)
    return df.where(between_days(df, moment, str(first), str(after)))


def period_columns(moment: str, month: datetime.date, periods: int = PERIODS) -> list[Column]:
    """Aggregates ``brq_count_p_k`` and ``num_days_p_k``, k months back; 0 where there was nothing."""
    at = F.col(moment)
    back = months_between_starts(F.lit(month), at)
    columns = []
    for k in range(periods):
        columns.append(F.count_if(back == k).alias(f"brq_count_p_{k}"))
        columns.append(active_days(at, back == k).alias(f"num_days_p_{k}"))
    return columns


def period_features(
    df: DataFrame, user: str, moment: str, month: datetime.date, periods: int = PERIODS
) -> DataFrame:
    """One row per user seen in the periods, with a pair of columns per period."""
    return in_periods(df, moment, month, periods).groupBy(user).agg(*period_columns(moment, month, periods))


def carrier_switches(
    df: DataFrame, user: str, order: list[str], carrier: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """How often a user's carrier differs from the last known one; rows without a carrier are no switch."""
    rows = with_previous(df.select(user, *order, carrier), [user], order, carrier, "_before", hot_rows, known=True)
    return rows.groupBy(user).agg(_switches(carrier, "_before"))


def single_carrier_users(df: DataFrame, user: str, carrier: str) -> DataFrame:
    """Users with exactly one distinct carrier. Pairs are made distinct and counted by hash; smallest and largest of text would sort all rows."""
    pairs = df.where(F.col(carrier).isNotNull()).select(user, carrier).distinct()
    return pairs.groupBy(user).agg(F.count("*").alias("_carriers")).where("_carriers = 1").select(user)


def keep_single_carrier(df: DataFrame, user: str, carrier: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The rows of users with exactly one distinct carrier."""
    return skewed_join(df, single_carrier_users(df, user, carrier), user, "left_semi", hot_rows)


def request_features(
    df: DataFrame,
    user: str,
    order: list[str],
    carrier: str,
    month: datetime.date,
    periods: int = PERIODS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All features of a user up to ``month``: last carrier, periods and carrier switches.

    The window and the aggregate share one partitioning by user.
    """
    moment = order[0]
    rows = in_periods(df, moment, month, periods).select(user, *order, carrier)
    rows = with_previous(rows, [user], order, carrier, "_before", hot_rows, known=True)
    return rows.groupBy(user).agg(
        F.max_by(carrier, F.struct(*order)).alias("carrier"),
        *period_columns(moment, month, periods),
        _switches(carrier, "_before"),
    )


def churn_labels(df: DataFrame, features: DataFrame, user: str, moment: str, month: datetime.date) -> DataFrame:
    """Add ``is_churn``: 1 for users without a request in the month after ``month``."""
    later = in_periods(df, moment, month_shift(month, 1), 1).groupBy(user).agg(F.lit(1).alias("_seen"))
    return features.join(later, user, "left").select(
        *features.columns, F.when(F.col("_seen").isNull(), 1).otherwise(0).alias("is_churn")
    )


def next_month_labels(df: DataFrame, user: str, moment: str, **labels: Column) -> DataFrame:
    """Labels of a user and month under the month before, to whose features they belong.

    The month is shifted before the aggregate, so labels and features are
    partitioned alike and their join shuffles nothing again.
    """
    month = F.add_months(month_of(F.col(moment)), -1).alias("month")
    return df.groupBy(user, month).agg(*[value.alias(name) for name, value in labels.items()])


def with_next_label(features: DataFrame, labels: DataFrame, user: str, month: str = "month") -> DataFrame:
    """Features of a month joined to the same user's stored labels of the following month."""
    shifted = labels.withColumn(month, F.add_months(month, -1))
    return features.join(shifted, [user, month], "inner")


def _switches(carrier: str, before: str) -> Column:
    # Without a carrier, or one before it, the comparison is NULL and is not counted.
    return F.count_if(F.col(carrier) != F.col(before)).alias("n_switches")
