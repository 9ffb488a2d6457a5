"""Streams that run over what has arrived and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.operators.slices import day_slice
from monthmill.plans.daily import DAY, SLICE_COLUMNS
from monthmill.plans.registry import query
from monthmill.plans.stand_ins import event_log
from monthmill.session import scratch_path
from monthmill.sources.logreader import arriving_records, can_open
from monthmill.sources.tables import parquet_table
from monthmill.streaming import jobs


def _stream(spark: SparkSession, folder: str, table: str) -> DataFrame:
    schema = parquet_table(spark, folder, table).schema
    return jobs.arriving_files(spark, folder, schema, pattern=f"{table}.parquet")


def _finished(spark: SparkSession, stream: DataFrame) -> DataFrame:
    base = scratch_path(spark, "stream")
    jobs.run_available(stream, f"{base}/out", f"{base}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query(
    """
    SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, event_type, count(*) AS n,
        round(sum(value), 2) AS total, max(value) AS largest
    FROM events GROUP BY 1, 2
    """
)
def stream_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics per type and 30 seconds, of all windows."""
    base = scratch_path(spark, "stream")
    jobs.fold_available(_stream(spark, folder, "events"), "ts", ["event_type"], "value", f"{base}/out", f"{base}/checkpoint")
    return jobs.folded(spark, f"{base}/out", {"event_type": "string"}).withColumn("total", F.round("total", 2))


@query(
    f"""
    SELECT event_id, user_id, event_type, value, split_part(ts::VARCHAR, ' ', 1) AS date
    FROM events WHERE split_part(ts::VARCHAR, ' ', 1) = '{DAY}'
    """
)
def stream_day_slice(spark: SparkSession, folder: str) -> DataFrame:
    """The day slice as an incremental job."""
    return _finished(spark, _stream(spark, folder, "events").transform(day_slice, DAY, "ts", SLICE_COLUMNS))


@query(
    """
    WITH r AS (
        SELECT date_trunc('millisecond', ts) AS ts, '/d/u' || user_id || '.py' AS source,
            CASE WHEN event_type IN ('click', 'purchase') THEN value END AS took FROM events)
    SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, source, count(*) AS n,
        round(sum(took), 2) AS total, max(took) AS largest
    FROM r GROUP BY 1, 2
    """
)
def stream_log_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Log records and durations per pipeline file and 30 seconds, from arriving log files."""
    path = scratch_path(spark, "log")
    event_log(spark, folder).write.text(path)
    base = scratch_path(spark, "stream")
    logs = arriving_records(spark, path) if can_open(path) else jobs.arriving_logs(spark, path)
    prepare = jobs.record_batch if can_open(path) else jobs.log_batch
    jobs.fold_available(logs, "ts", ["source"], "took", f"{base}/out", f"{base}/checkpoint", prepare=prepare)
    return jobs.folded(spark, f"{base}/out", {"source": "string"}).withColumn("total", F.round("total", 2))
