"""Files, partitioned tables, named tables and models."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from monthmill.sources.tables import MARKET_PARTITIONS


def stamp(now: datetime | None = None) -> str:
    """The run stamp of an output path; it has no colon and no blank."""
    return (now or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S")


def export_csv(df: DataFrame, base: str, now: datetime | None = None) -> str:
    """Write CSV files with headers under a run-stamped folder and return its path."""
    path = f"{base.rstrip('/')}/run_ts={stamp(now)}"
    df.write.option("header", True).csv(path)
    return path


def put(df: DataFrame, root: str, key: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Write under a root (a bucket or folder) and key of the caller's choice."""
    path = f"{root.rstrip('/')}/{key.lstrip('/')}"
    df.write.format(fmt).mode(mode).save(path)
    return path


def write_months(df: DataFrame, base: str, gather: bool = True) -> None:
    """Write ``market=…/data_month=…`` folders; a rerun replaces only the months it holds.

    ``gather`` brings the rows of a month together before the write, which
    keeps the number of files down; Spark splits a month that is too large
    for one writer. Without it rows are written where they are.
    """
    rows = df.hint("rebalance", *MARKET_PARTITIONS) if gather else df
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*MARKET_PARTITIONS)
        .parquet(base)
    )


def write_named(df: DataFrame, database: str, table: str, location: str) -> None:
    """Write a table of a named database whose files live at ``location``, the database's own folder beside it."""
    quoted = location.rstrip("/").replace("'", "\\'")
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{quoted}-database'")
    df.write.mode("overwrite").option("path", location).saveAsTable(f"{database}.{table}")


def save_model(model: PipelineModel, base: str, market: str, model_type: str, month: str) -> str:
    """Store a trained model under its market, type and month; a rerun replaces it."""
    path = model_path(base, market, model_type, month)
    model.write().overwrite().save(path)
    return path


def model_path(base: str, market: str, model_type: str, month: str) -> str:
    return f"{base.rstrip('/')}/{market}/{model_type}/{month}"


def show(df: DataFrame, rows: int = 20) -> None:
    """Print the first rows of a result."""
    df.show(rows, truncate=False)
