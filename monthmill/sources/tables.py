"""Tables from files, query text, JSON documents and CSV lists."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MARKET_PARTITIONS = ["market", "data_month"]

VALID_APPS = T.StructType([T.StructField("app", T.StringType())])
CLASS_TARGETS = T.StructType(
    [
        T.StructField("market", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("target_share", T.DoubleType()),
    ]
)


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query_rows(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """The rows of a SQL text, over views and, by ``{name}``-style references, over ``tables``."""
    return spark.sql(text, **(tables or {}))


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """A CSV list with a declared schema; a malformed line stops the job."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def record_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Scoring input in which each line is one CSV record, without a header."""
    return csv_table(spark, path, schema, header=False)


def avro_table(spark: SparkSession, path: str) -> DataFrame:
    """Avro files. Needs the spark-avro module on the cluster's class path."""
    return spark.read.format("avro").load(path)


def document_source(spark: SparkSession, *documents: str) -> DataFrame:
    """Inline JSON documents, one row each, in column ``document``."""
    return spark.createDataFrame([(d,) for d in documents], "document string")


def market_month(spark: SparkSession, base: str, market: str, month: str) -> DataFrame:
    """One month of one market from ``base/market=…/data_month=…``.

    The folder is addressed by name, so the other folders, of which there may
    be many thousands, are not even listed.
    """
    if not re.fullmatch(r"\d{4}(0[1-9]|1[0-2])", month):
        raise ValueError(f"month must be yyyymm, not {month!r}")
    if not re.fullmatch(r"\w+", market):
        raise ValueError(f"not a market: {market!r}")
    rows = spark.read.parquet(f"{base.rstrip('/')}/market={market}/data_month={month}")
    return rows.withColumns({"market": F.lit(market), "data_month": F.lit(month)})


def market_months(spark: SparkSession, base: str, fields: T.StructType) -> DataFrame:
    """All months of all markets; a filter on market and month prunes the folders.

    The partition columns are text: "200107" must not turn into a number.
    """
    names = [T.StructField(p, T.StringType()) for p in MARKET_PARTITIONS]
    return spark.read.schema(T.StructType([*fields, *names])).parquet(base)
