"""Pipelines of table to table functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, types as T


def run_steps(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply functions one after the other; together they make one plan."""
    for step in steps:
        df = df.transform(step)
    return df


def map_batches(df: DataFrame, function: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str) -> DataFrame:
    """Apply a caller's Python function to each Arrow batch of rows.

    For functions Spark cannot look into. Batches are arbitrary parts of the
    table, so the function must treat rows one by one or in any grouping.
    """

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield function(part)

    return df.mapInPandas(batches, schema)
