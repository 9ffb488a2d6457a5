"""The test tables in the shape of the data the operators are for.

Customers play users of a market (their nation), orders play requests with
the order priority as carrier, events play log records and metrics.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthmill.functions.dates import month_id, month_of
from monthmill.operators.routing import MARKET_SIZES
from monthmill.sources.tables import parquet_table

REQUEST_ORDER = ["o_orderdate", "o_orderkey"]
REFERENCE_MONTH = datetime.date(2001, 7, 1)

MARKET_SQL = "coalesce(list_extract([%s], c_nationkey + 1), 'N' || c_nationkey)" % ", ".join(
    f"'{m}'" for m in MARKET_SIZES
)


def market_code(nation_key: Column) -> Column:
    """A market code for the first nations, ``N`` and the key for the rest."""
    codes = F.array(*[F.lit(m) for m in MARKET_SIZES])
    return F.coalesce(F.get(codes, nation_key), F.concat(F.lit("N"), nation_key.cast("string")))


def user_markets(spark: SparkSession, folder: str) -> DataFrame:
    """``user_id, market``."""
    customers = parquet_table(spark, folder, "customer")
    return customers.select(F.col("c_custkey").alias("user_id"), market_code(F.col("c_nationkey")).alias("market"))


def market_months(spark: SparkSession, folder: str) -> DataFrame:
    """``market, data_month`` of all months in which a market has requests.

    A user's months are made distinct before they are joined with the user's market.
    """
    orders = parquet_table(spark, folder, "orders")
    months = orders.select(F.col("o_custkey").alias("user_id"), month_of(F.col("o_orderdate")).alias("month"))
    joined = months.distinct().join(user_markets(spark, folder), "user_id")
    return joined.select("market", "month").distinct().select("market", month_id(F.col("month")).alias("data_month"))


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    """One log record per event, in column ``record``: failed imports with a traceback,
    warnings, pipeline lists and durations."""
    events = parquet_table(spark, folder, "events")
    stamp = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000] "))
    path = F.concat(F.lit("/d/u"), F.col("user_id").cast("string"), F.lit(".py"))
    pipelines = F.transform(
        F.sequence(F.lit(0), (F.col("user_id") % 3).cast("int")),
        lambda i: F.concat(F.lit("'p"), i.cast("string"), F.lit("'")),
    )
    error = F.concat(
        stamp,
        F.lit("{logging_mixin.py:115} INFO - "),
        stamp,
        F.lit("{dagbag.py:321} ERROR - Failed to import: "),
        path,
        F.lit("\nTraceback (most recent call last):\n  event "),
        F.col("event_id").cast("string"),
    )
    listed = F.concat(
        stamp,
        F.lit("{processor.py:650} INFO - DAG(s) dict_keys(["),
        F.array_join(pipelines, ", "),
        F.lit("]) retrieved from "),
        path,
    )
    warning = F.concat(stamp, F.lit("{processor.py:652} WARNING - No viable dags retrieved from "), path)
    took = F.concat(
        stamp,
        F.lit("{processor.py:161} INFO - Processing "),
        path,
        F.lit(" took "),
        F.col("value").cast("string"),
        F.lit(" seconds"),
    )
    kind = F.col("event_type")
    record = F.when(kind == "error", error).when(kind == "signup", listed).when(kind == "view", warning).otherwise(took)
    return events.select(record.alias("record"))


def run_log(spark: SparkSession, folder: str) -> DataFrame:
    """Log records of starts (from views) and ends (from clicks and purchases) of runs, in column ``record``."""
    events = parquet_table(spark, folder, "events").where(F.col("event_type").isin("view", "click", "purchase"))
    stamp = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000] "))
    path = F.concat(F.lit("/d/u"), F.col("user_id").cast("string"), F.lit(".py"))
    start = F.concat(stamp, F.lit("{processor.py:153} INFO - Started process (PID="), F.col("event_id").cast("string"), F.lit(") to work on "), path)
    end = F.concat(stamp, F.lit("{processor.py:161} INFO - Processing "), path, F.lit(" took "), F.col("value").cast("string"), F.lit(" seconds"))
    return events.select(F.when(F.col("event_type") == "view", start).otherwise(end).alias("record"))
