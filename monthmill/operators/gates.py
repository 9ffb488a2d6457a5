"""The best of several metrics and what follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PASSED = "accurate"
FAILED = "inaccurate"


def verdict(value: Column, threshold: float) -> Column:
    """``accurate`` from the threshold on, else ``inaccurate``."""
    return F.when(value >= threshold, PASSED).otherwise(FAILED)


def best_metric(df: DataFrame, keys: list[str], metric: str, threshold: float) -> DataFrame:
    """Per group: the best metric, how many are missing, and the verdict."""
    best = df.groupBy(*keys).agg(
        F.max(metric).alias("best"),
        F.count_if(F.col(metric).isNull()).alias("n_missing"),
    )
    return best.withColumn("branch", verdict(F.col("best"), threshold))


def best_candidate(df: DataFrame, keys: list[str], metric: str, candidate: str) -> DataFrame:
    """Per group: the candidate with the highest metric; the smallest id wins a tie.

    An aggregate, so each task sends one row per group. A group with only
    missing metrics stays, with NULL for both.
    """
    rank = F.when(F.col(metric).isNotNull(), F.struct((-F.col(metric)).alias("m"), F.col(candidate)))
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(metric, candidate), rank).alias("top"))
    return picked.select(*keys, f"top.{candidate}", f"top.{metric}")


def branches(df: DataFrame, branch: str = "branch") -> dict[str, DataFrame]:
    """The rows of each branch."""
    return {label: df.where(F.col(branch) == label) for label in (PASSED, FAILED)}
