"""Tables and queries of a database, read in parallel where bounds are known."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Database:
    """Where a database is. Credentials come from the caller, never from this package."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    properties: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        if not self.url.startswith("jdbc:"):
            raise ValueError("a JDBC url starts with 'jdbc:'")
        found = {"url": self.url, "user": self.user, "password": self.password, **self.properties}
        return {key: value for key, value in found.items() if value is not None}


@dataclass(frozen=True)
class Split:
    """Bounds by which a table scan is cut into parallel reads.

    The bounds only place the cuts: rows below and above them are read too.
    """

    column: str
    lower: str | int
    upper: str | int
    partitions: int

    def options(self) -> dict[str, str]:
        if self.partitions < 1:
            raise ValueError("partitions must be positive")
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }


def table_options(db: Database, table: str, split: Split | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    return {
        **db.options(),
        "dbtable": table,
        "fetchsize": str(fetch_size),
        **(split.options() if split else {}),
    }


def query_options(db: Database, query: str, fetch_size: int = 10_000) -> dict[str, str]:
    """Options for a query; the trailing semicolon a SQL text may carry is dropped."""
    return {**db.options(), "query": query.strip().rstrip(";").rstrip(), "fetchsize": str(fetch_size)}


def read_table(spark: SparkSession, db: Database, table: str, split: Split | None = None) -> DataFrame:
    """A table scan; filters and the column list reach the database."""
    return spark.read.format("jdbc").options(**table_options(db, table, split)).load()


def read_query(spark: SparkSession, db: Database, query: str) -> DataFrame:
    """The rows of a query, straight into a DataFrame. Failures are raised."""
    return spark.read.format("jdbc").options(**query_options(db, query)).load()
