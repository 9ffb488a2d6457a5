"""Per-user features from stored months: each month is read once, when it is over."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthmill.operators.features import PERIODS, in_periods, month_shift
from monthmill.operators.ordered import HOT_ROWS, with_previous

MONTH = "data_month"


def month_summary(df: DataFrame, user: str, order: list[str], carrier: str, month: datetime.date, hot_rows: int = HOT_ROWS) -> DataFrame:
    """What is kept of a user's month: rows, a bit per active day, the last row's carrier, the first and last known ones, and switches."""
    moment = order[0]
    rows = in_periods(df, moment, month, 1).select(user, *order, carrier)
    rows = with_previous(rows, [user], order, carrier, "_before", hot_rows, known=True)
    at = F.struct(*order)
    known = F.when(F.col(carrier).isNotNull(), at)
    return rows.groupBy(user).agg(
        F.count("*").alias("n"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.dayofmonth(moment) - 1)).alias("days"),
        F.max_by(carrier, at).alias("carrier"),
        F.min_by(carrier, known).alias("first_known"),
        F.max_by(carrier, known).alias("last_known"),
        F.count_if(F.col(carrier) != F.col("_before")).alias("n_switches"),
    )


def store_month(df: DataFrame, base: str, user: str, order: list[str], carrier: str, month: datetime.date) -> None:
    """Write one month of ``df`` below ``base``; only its rows are read, and only its folder is replaced."""
    summary = month_summary(df, user, order, carrier, month)
    summary.write.mode("overwrite").parquet(f"{base}/{MONTH}={month:%Y%m}")


def stored_features(spark: SparkSession, base: str, user: T.StructField, carrier: T.StructField, month: datetime.date, periods: int = PERIODS) -> DataFrame:
    """The features of ``request_features`` from the stored months up to ``month``; months that are not stored count as empty.

    Counts and days are merged as they are. Switches between months compare
    the first known carrier of a month with the last known one before it, over
    at most ``periods`` entries a user. One shuffle, of a row per user and month.
    """
    kept = T.StructType([T.StructField(user.name, user.dataType), *T.StructType.fromDDL("n long, days int")])
    for name in ("carrier", "first_known", "last_known"):
        kept = kept.add(name, carrier.dataType)
    kept = kept.add("n_switches", "long").add(MONTH, "string")
    wanted = [f"{month_shift(month, -k):%Y%m}" for k in range(periods)]
    months = spark.read.schema(kept).parquet(base).where(F.col(MONTH).isin(wanted))
    columns = []
    for k, name in enumerate(wanted):
        mine = F.col(MONTH) == name
        columns.append(F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"brq_count_p_{k}"))
        columns.append(F.coalesce(F.bit_count(F.bit_or(F.when(mine, F.col("days")))), F.lit(0)).cast("long").alias(f"num_days_p_{k}"))
    known = F.when(F.col("first_known").isNotNull(), F.struct(MONTH, "first_known", "last_known"))
    merged = months.groupBy(user.name).agg(
        F.max_by("carrier", MONTH).alias("carrier"), *columns, F.sum("n_switches").alias("_inside"), F.array_sort(F.collect_list(known)).alias("_months")
    )
    later = F.slice("_months", 2, periods)
    pairs = F.zip_with(F.slice("_months", 1, periods), later, lambda a, b: (a["last_known"] != b["first_known"]).cast("long"))
    between = F.aggregate(pairs, F.lit(0).cast("long"), lambda total, x: total + F.coalesce(x, F.lit(0)))
    return merged.withColumn("n_switches", F.col("_inside") + between).drop("_inside", "_months")
