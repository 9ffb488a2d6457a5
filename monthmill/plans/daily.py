"""Day slices, query texts, JSON totals and the best of several metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.functions import documents, names
from monthmill.operators import features, gates, slices, steps
from monthmill.plans.registry import query
from monthmill.sources.tables import parquet_table, query_rows

DAY = "2024-01-05"
SLICE_COLUMNS = ["event_id", "user_id", "event_type", "value"]


@query(
    f"""
    SELECT event_id, user_id, event_type, value, split_part(ts::VARCHAR, ' ', 1) AS date
    FROM events WHERE split_part(ts::VARCHAR, ' ', 1) = '{DAY}'
    """
)
def day_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of one day, by a range that reaches the scan."""
    events = parquet_table(spark, folder, "events")
    return events.transform(slices.day_slice, DAY, "ts", SLICE_COLUMNS)


@query(
    f"""
    SELECT event_id, user_id, event_type, value, split_part(ts::VARCHAR, ' ', 1) AS date
    FROM events WHERE split_part(ts::VARCHAR, ' ', 1) = '{DAY}'
    """
)
def text_day_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The same slice of times that are stored as text, by splitting them."""
    events = parquet_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("string"))
    return events.transform(slices.day_slice, DAY, "ts", SLICE_COLUMNS)


@query("SELECT * FROM customer")
def sql_text_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of a SQL text."""
    return query_rows(spark, "Select * from {users};", {"users": parquet_table(spark, folder, "customer")})


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 1")
def first_row(spark: SparkSession, folder: str) -> DataFrame:
    """The first order."""
    return slices.first_row(parquet_table(spark, folder, "orders"), "o_orderkey")


@query(
    """
    SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS DOUBLE)) AS total_order_value
    FROM events GROUP BY event_type
    """
)
def json_map_total(spark: SparkSession, folder: str) -> DataFrame:
    """The sum of all numbers in JSON maps."""
    events = parquet_table(spark, folder, "events")
    total = documents.map_total(documents.number_map(F.col("props")))
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(total).alias("total_order_value"))


@query(
    """
    SELECT user_id, sum(CAST(json_extract(props, '$.k') AS DOUBLE)) AS total_order_value
    FROM events GROUP BY user_id
    """
)
def json_result(spark: SparkSession, folder: str) -> DataFrame:
    """Totals written as JSON documents and read again."""
    events = parquet_table(spark, folder, "events")
    total = documents.map_total(documents.number_map(F.col("props")))
    written = events.groupBy("user_id").agg(F.sum(total).alias("total")).select(
        "user_id", documents.result_document(total_order_value=F.col("total")).alias("document")
    )
    return written.select(
        "user_id", documents.number_map(F.col("document"))["total_order_value"].alias("total_order_value")
    )


@query(
    """
    SELECT o_orderkey, '{"id":"' || o_orderkey || '","status":"' || o_orderstatus || '","date":"' ||
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"}' AS document
    FROM orders
    """
)
def text_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Records as JSON documents in which every value is a string."""
    document = documents.text_document(
        id=F.col("o_orderkey"), status=F.col("o_orderstatus"), date=F.col("o_orderdate")
    )
    return parquet_table(spark, folder, "orders").select("o_orderkey", document.alias("document"))


@query(
    """
    SELECT user_id, max(value) AS best, count(*) FILTER (WHERE value IS NULL) AS n_missing,
        CASE WHEN max(value) >= 400 THEN 'accurate' ELSE 'inaccurate' END AS branch
    FROM events GROUP BY user_id
    """
)
def best_gate(spark: SparkSession, folder: str) -> DataFrame:
    """The best metric of each group against a threshold."""
    return gates.best_metric(parquet_table(spark, folder, "events"), ["user_id"], "value", 400)


@query(
    """
    SELECT branch, count(*) AS n FROM (
        SELECT CASE WHEN max(value) >= 400 THEN 'accurate' ELSE 'inaccurate' END AS branch
        FROM events GROUP BY user_id, ts::DATE)
    GROUP BY branch
    """
)
def branch_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """How many groups take each branch."""
    events = parquet_table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    return gates.best_metric(events, ["user_id", "day"], "value", 400).groupBy("branch").agg(F.count("*").alias("n"))


@query(
    """
    SELECT user_id, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events)
    WHERE rn = 1
    """
)
def best_candidate(spark: SparkSession, folder: str) -> DataFrame:
    """Which candidate of each group is best."""
    return gates.best_candidate(parquet_table(spark, folder, "events"), ["user_id"], "value", "event_id")


@query(
    """
    SELECT strftime(ts::DATE, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total
    FROM events GROUP BY ts::DATE, event_type
    """
)
def daily_agg(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and sums per day and type."""
    totals = features.daily_totals(parquet_table(spark, folder, "events"), "ts", ["event_type"], "value")
    return totals.select(F.col("day").cast("string").alias("day"), "event_type", "n", F.round("total", 2).alias("total"))


@query(
    """
    SELECT event_type, count(*) AS n, count(*) AS n_in_range FROM events GROUP BY event_type
    """
)
def random_draws(spark: SparkSession, folder: str) -> DataFrame:
    """A seeded draw from 1 to 10 per row; none lies outside."""
    drawn = parquet_table(spark, folder, "events").select("event_type", names.random_integer(7).alias("draw"))
    return drawn.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("draw").between(1, 10)).alias("n_in_range")
    )


@query(
    f"""
    SELECT event_id, event_type, value * 2 AS doubled, split_part(ts::VARCHAR, ' ', 1) AS date
    FROM events WHERE split_part(ts::VARCHAR, ' ', 1) = '{DAY}'
    """
)
def python_step(spark: SparkSession, folder: str) -> DataFrame:
    """A slice followed by a caller's Python function over Arrow batches."""

    def doubled(batch: pd.DataFrame) -> pd.DataFrame:
        return batch.assign(doubled=batch["value"] * 2).drop(columns="value")

    return steps.run_steps(
        parquet_table(spark, folder, "events"),
        lambda df: slices.day_slice(df, DAY, "ts", ["event_id", "event_type", "value"]),
        lambda df: steps.map_batches(df, doubled, "event_id long, event_type string, date string, doubled double"),
    )
