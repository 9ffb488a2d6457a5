"""Tables written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.functions.dates import month_id
from monthmill.operators.lookups import lookup
from monthmill.plans.registry import query
from monthmill.plans.stand_ins import MARKET_SQL, user_markets
from monthmill.session import scratch_path
from monthmill.sinks import files
from monthmill.sources import tables


@query("SELECT * FROM part")
def csv_export(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV export under a run stamp, read with a declared schema."""
    part = tables.parquet_table(spark, folder, "part")
    path = files.export_csv(part, scratch_path(spark, "export"))
    return tables.csv_table(spark, path, part.schema)


@query("SELECT * FROM supplier")
def scoring_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Scoring input with one record per line and no header."""
    supplier = tables.parquet_table(spark, folder, "supplier")
    path = files.put(supplier, scratch_path(spark, "lines"), "batch/input", "csv")
    return tables.record_lines(spark, path, supplier.schema)


@query(
    f"""
    SELECT o_orderkey, o_custkey, {MARKET_SQL} AS market, strftime(o_orderdate, '%Y%m') AS data_month
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE {MARKET_SQL} = 'MY' AND strftime(o_orderdate, '%Y%m') = '200107'
    """
)
def market_month(spark: SparkSession, folder: str) -> DataFrame:
    """All months written by market and month; one month of one market read back."""
    orders = tables.parquet_table(spark, folder, "orders")
    requests = orders.select("o_orderkey", "o_custkey", month_id(F.col("o_orderdate")).alias("data_month"))
    markets = user_markets(spark, folder).withColumnRenamed("user_id", "o_custkey")
    base = scratch_path(spark, "requests")
    files.write_months(lookup(requests, markets, "o_custkey", "inner"), base)
    return tables.market_month(spark, base, "MY", "200107")


@query("SELECT * FROM customer")
def named_table(spark: SparkSession, folder: str) -> DataFrame:
    """A table of a named database, read by its name."""
    customers = tables.parquet_table(spark, folder, "customer")
    files.write_named(customers, "monthmill", "customers", scratch_path(spark, "named"))
    return spark.table("monthmill.customers")
