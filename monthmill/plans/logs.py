"""Pipeline logs: records, levels, statistics and latest runs per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from monthmill.operators import logs, sketches
from monthmill.plans.registry import query
from monthmill.plans.stand_ins import event_log, run_log
from monthmill.session import durable, scratch_path
from monthmill.sources.logfiles import log_records

_RUNS = "event_type IN ('click', 'purchase')"


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return logs.measured(logs.log_fields(event_log(spark, folder)))


@query(
    """
    SELECT date_trunc('millisecond', ts) AS ts,
        CASE event_type WHEN 'error' THEN 'dagbag.py' ELSE 'processor.py' END AS module,
        CASE event_type WHEN 'error' THEN 321 WHEN 'signup' THEN 650 WHEN 'view' THEN 652 ELSE 161 END AS lineno,
        CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level,
        CASE event_type WHEN 'error' THEN 'Failed to import: /d/u' || user_id || '.py'
            WHEN 'view' THEN 'No viable dags retrieved from /d/u' || user_id || '.py'
            WHEN 'signup' THEN 'DAG(s) dict_keys([' || CASE user_id % 3 WHEN 0 THEN '''p0''' WHEN 1 THEN '''p0'', ''p1'''
                ELSE '''p0'', ''p1'', ''p2''' END || ']) retrieved from /d/u' || user_id || '.py'
            ELSE 'Processing /d/u' || user_id || '.py took ' || value || ' seconds' END AS message,
        CASE event_type WHEN 'error' THEN 'Traceback (most recent call last):' || chr(10) || '  event ' || event_id END
            AS continuation
    FROM events
    """
)
def log_assembly(spark: SparkSession, folder: str) -> DataFrame:
    """Log files written and read again: whole records with their continuation lines, unwrapped."""
    path = scratch_path(spark, "log")
    event_log(spark, folder).write.text(path)
    return logs.log_fields(log_records(spark, path)).drop("file")


@query(
    """
    SELECT '/d/u' || user_id || '.py' AS source,
        CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'WARNING' ELSE 'INFO' END AS level, count(*) AS n
    FROM events GROUP BY 1, 2
    """
)
def log_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Records per file and level."""
    return logs.level_counts(_records(spark, folder), "source")


@query(
    f"""
    SELECT '/d/u' || user_id || '.py' AS source, count(*) AS n_records,
        count(*) FILTER (WHERE event_type = 'error') AS n_errors,
        count(*) FILTER (WHERE event_type = 'view') AS n_warnings,
        count(*) FILTER (WHERE event_type = 'error') AS n_failed_imports,
        count(*) FILTER (WHERE event_type = 'error') AS n_continued,
        coalesce(max(CASE WHEN event_type = 'signup' THEN user_id % 3 + 1 END), 0)::INT AS n_pipelines,
        count(*) FILTER (WHERE {_RUNS}) AS n_runs,
        min(value) FILTER (WHERE {_RUNS}) AS min_took, max(value) FILTER (WHERE {_RUNS}) AS max_took,
        round(avg(value) FILTER (WHERE {_RUNS}), 6) AS mean_took,
        round(median(value) FILTER (WHERE {_RUNS}), 6) AS median_took
    FROM events GROUP BY user_id
    """
)
def log_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Errors, pipelines and durations per file, in listing order."""
    stats = logs.in_listing_order(logs.file_stats(_records(spark, folder)))
    return stats.withColumns({c: F.round(c, 6) for c in ["mean_took", "median_took"]})


@query(
    f"""
    SELECT source, ts AS last_run, value AS last_took FROM (
        SELECT '/d/u' || user_id || '.py' AS source, date_trunc('millisecond', ts) AS ts, value,
            row_number() OVER (PARTITION BY user_id ORDER BY date_trunc('millisecond', ts) DESC, value DESC) AS rn
        FROM events WHERE {_RUNS}) WHERE rn = 1
    """
)
def log_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The last run of each file and how long it took."""
    return logs.latest_runs(_records(spark, folder))


@query(
    """
    WITH marks AS (
        SELECT user_id, date_trunc('millisecond', ts) AS ts, event_type <> 'view' AS ends,
            CASE WHEN event_type = 'view' THEN event_id ELSE -1 END AS pid, CASE WHEN event_type = 'view' THEN -1.0 ELSE value END AS took
        FROM events WHERE event_type IN ('view', 'click', 'purchase')),
    near AS (
        SELECT *, lag(ends) OVER w AS ended_before, lag(ts) OVER w AS ts_before, lag(pid) OVER w AS pid_before,
            lead(ends) OVER w AS ends_next
        FROM marks WINDOW w AS (PARTITION BY user_id ORDER BY ts, ends, pid, took))
    SELECT '/d/u' || user_id || '.py' AS source, CASE WHEN NOT ended_before THEN pid_before END AS pid,
        CASE WHEN NOT ended_before THEN ts_before END AS started, ts AS ended, took,
        CASE WHEN NOT ended_before THEN 'finished' ELSE 'unstarted' END AS state
    FROM near WHERE ends
    UNION ALL
    SELECT '/d/u' || user_id || '.py', pid, ts, NULL, NULL, 'open' FROM near WHERE NOT ends AND NOT coalesce(ends_next, false)
    """
)
def log_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of each file: starts paired with their ends, open ones and ends without a start."""
    return logs.run_spans(logs.measured(logs.log_fields(run_log(spark, folder))))


@query(
    f"""
    SELECT '/d/u' || user_id || '.py' AS source, count(*) AS n_runs, min(value) AS min_took, max(value) AS max_took, true AS median_in_bounds
    FROM events WHERE {_RUNS} GROUP BY user_id
    """
)
def log_duration_sketches(spark: SparkSession, folder: str) -> DataFrame:
    """Sketches of durations per file and day, stored and merged per file; their median has a rank within the bound."""
    records = _records(spark, folder).select("source", "ts", "took")
    stored = durable(sketches.duration_sketches(records), "sketches")
    merged = sketches.merged_sketches(stored, ["source"]).withColumn("middle", sketches.quantile(0.5)).drop("sketch")
    runs = records.where(F.col("took").isNotNull()).join(merged, "source")
    below, upto = F.count_if(F.col("took") < F.col("middle")), F.count_if(F.col("took") <= F.col("middle"))
    slack = F.greatest(F.lit(1.0), sketches.RANK_ERROR * F.col("n_runs"))
    checked = runs.groupBy("source").agg(F.max("n").alias("n_runs"), F.max("smallest").alias("min_took"), F.max("largest").alias("max_took"), below.alias("low"), upto.alias("high"))
    fits = (F.col("low") <= F.col("n_runs") / 2 + slack) & (F.col("high") >= F.col("n_runs") / 2 - slack)
    return checked.select("source", "n_runs", "min_took", "max_took", fits.alias("median_in_bounds"))
