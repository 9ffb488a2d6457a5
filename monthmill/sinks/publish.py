"""Outputs by market and month with a commit point: a run is seen whole or not at all.

Below a base folder, ``runs/run=.../market=.../data_month=...`` holds what the
runs wrote and ``commits`` one small file per committed run, with a line per
market and month the run stands for. A reader takes each market and month from
the last commit that names it. What a failed run left behind is never read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from monthmill.sinks.files import write_months
from monthmill.sources.tables import MARKET_PARTITIONS, market_months

COMMIT = "number long, run string, market string, data_month string, n_rows long"


class Refused(ValueError):
    """A staged run that must not be published."""


def _run_folder(base: str, run: str) -> str:
    return f"{base.rstrip('/')}/runs/run={run}"


def stage(df: DataFrame, base: str, run: str | None = None) -> str:
    """Write a run's rows, which have ``market`` and ``data_month``, where no reader looks; returns the run's name."""
    run = run or uuid.uuid4().hex
    write_months(df, _run_folder(base, run))
    return run


def staged(spark: SparkSession, base: str, run: str, fields: list[T.StructField]) -> DataFrame:
    """The rows of a run, committed or not."""
    return market_months(spark, _run_folder(base, run), fields)


def validate(rows: DataFrame, rules: dict[str, Column], unique: list[str] | None = None) -> dict[tuple[str, str], int]:
    """Rows per market and month, if every row keeps every rule and no key repeats within a market and month.

    A rule that is null counts as broken. Keys are counted by one more
    shuffle; everything else is one aggregate per market and month.
    """
    broken = [F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    found = rows.groupBy(*MARKET_PARTITIONS).agg(F.count("*").alias("n"), *broken).collect()  # a row per market and month
    wrong = [f"{row.market}/{row.data_month}: {row[f'_{i}']} rows break {name!r}" for row in found for i, name in enumerate(rules) if row[f"_{i}"]]
    if unique:
        repeated = rows.groupBy(*MARKET_PARTITIONS, *unique).count().where("count > 1").groupBy(*MARKET_PARTITIONS).count().collect()
        wrong += [f"{row.market}/{row.data_month}: {row['count']} keys repeat" for row in repeated]
    if wrong:
        raise Refused("; ".join(sorted(wrong)))
    return {(row.market, row.data_month): row.n for row in found}


def commits(spark: SparkSession, base: str) -> DataFrame:
    """All commits: ``number, run, market, data_month, n_rows``."""
    try:
        return spark.read.schema(COMMIT).json(f"{base.rstrip('/')}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def commit(spark: SparkSession, base: str, run: str, sizes: dict[tuple[str, str], int]) -> int:
    """Make a run the one that is read for its markets and months. One file appears, in one step.

    A market and month of size 0 is taken away from the readers. A run that is
    committed again changes nothing. Two runs that commit at once get the same
    number; then the greater name counts, for every reader.
    """
    known = commits(spark, base)
    if known.where(F.col("run") == run).limit(1).count():
        return known.where(F.col("run") == run).agg(F.max("number")).first()[0]
    number = (known.agg(F.max("number")).first()[0] or 0) + 1
    lines = [(number, run, market, month, n) for (market, month), n in sorted(sizes.items())]
    spark.createDataFrame(lines, COMMIT).coalesce(1).write.mode("append").json(f"{base.rstrip('/')}/commits")
    return number


def current(spark: SparkSession, base: str) -> DataFrame:
    """The last commit of each market and month."""
    order = Window.partitionBy(*MARKET_PARTITIONS).orderBy(F.col("number").desc(), F.col("run").desc())
    return commits(spark, base).withColumn("_nr", F.row_number().over(order)).where("_nr = 1").drop("_nr")


def published(spark: SparkSession, base: str, fields: list[T.StructField]) -> DataFrame:
    """What readers see: ``fields``, ``market`` and ``data_month`` of the last committed run of each market and month.

    The folders are named by the commits, so nothing else is listed.
    """
    rows = current(spark, base).where("n_rows > 0").orderBy(*MARKET_PARTITIONS).collect()  # a row per market and month
    typed = T.StructType([*fields, *[T.StructField(p, T.StringType()) for p in MARKET_PARTITIONS]])
    if not rows:
        return spark.createDataFrame([], typed)
    folders = [f"{_run_folder(base, row.run)}/market={row.market}/data_month={row.data_month}" for row in rows]
    runs = T.StructType([*typed, T.StructField("run", T.StringType())])
    return spark.read.schema(runs).option("basePath", f"{base.rstrip('/')}/runs").parquet(*folders).select(typed.names)


def publish(
    df: DataFrame,
    base: str,
    rules: dict[str, Column] | None = None,
    unique: list[str] | None = None,
    covers: list[tuple[str, str]] | None = None,
    run: str | None = None,
    before_commit: Callable[[str], None] = lambda run: None,
) -> str:
    """Stage, validate and commit one run; returns its name.

    ``covers`` lists markets and months the run stands for even if it has no
    rows of them: what was published for them before is no longer seen. If
    anything fails before the commit, readers see what they saw before.
    """
    spark = df.sparkSession
    fields = [f for f in df.schema.fields if f.name not in MARKET_PARTITIONS]
    run = stage(df, base, run)
    sizes = dict.fromkeys(covers or [], 0)
    if not df.sparkSession.read.schema(df.schema).option("recursiveFileLookup", True).parquet(_run_folder(base, run)).isEmpty():
        sizes |= validate(staged(spark, base, run, fields), rules or {}, unique)
    before_commit(run)
    commit(spark, base, run, sizes)
    return run
