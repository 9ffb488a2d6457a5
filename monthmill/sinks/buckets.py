"""Tables stored in buckets by user, so that two of them are joined without a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_buckets(df: DataFrame, database: str, table: str, location: str, keys: list[str], buckets: int) -> None:
    """Store a table with ``buckets`` files by a hash of ``keys``, each sorted by them.

    The rows are shuffled once, here. Tables with as many buckets by the same
    keys are then joined and grouped by them where they lie: by user if each
    holds one month, by user and month else. Choose buckets of some hundred
    megabytes. A key with very many rows makes one large bucket: store such
    tables without.
    """
    quoted = location.rstrip("/").replace("'", "\\'")
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{quoted}-database'")
    rows = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", location).saveAsTable(f"{database}.{table}")
