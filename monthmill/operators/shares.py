"""Class shares per market and the weights that move them to a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def class_shares(df: DataFrame, market: str, klass: str, rows: str | None = None) -> DataFrame:
    """Rows and share of each class within its market; ``rows`` names a column of counts to add up."""
    size = F.count("*") if rows is None else F.sum(rows)
    counts = df.groupBy(market, klass).agg(size.alias("n"))
    # The window holds one row per class of a market, not the rows counted.
    total = F.sum("n").over(Window.partitionBy(market))
    return counts.withColumn("share", F.col("n") / total)


def class_weights(predicted: DataFrame, target: DataFrame, market: str, klass: str) -> DataFrame:
    """Target share divided by predicted share, per market and class; NULL where either is missing."""
    joined = predicted.join(target, [market, klass], "full")
    return joined.withColumn("weight", F.col("target_share") / F.col("share"))
