"""Fields of log records and statistics per file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from monthmill.operators.ordered import HOT_ROWS, with_previous
from monthmill.session import durable

# The layout of a log record and of the messages measured.
HEADER = r"^\[([^\]]+)\] \{([^:}]+):(\d+)\} ([A-Z]+) - "
TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSZ"
TOOK = r"took ([0-9.]+) seconds"
SOURCE_FILE = (
    r"^(?:Started process .* to work on|Processing file|Processing|Filling up the DagBag from|Failed to import:"
    r"|No viable dags retrieved from|DAG\(s\) .* retrieved from) (/\S+)"
)
STARTED = r"^Started process \(PID=(\d+)\) to work on "
PIPELINE_LIST = r"dict_keys\(\[(.*?)\]\)"
QUOTED = r"'([^']*)'"


def log_fields(records: DataFrame, record: str = "record") -> DataFrame:
    """Split each record into ``ts, module, lineno, level, message, continuation``.

    A record logged inside another is unwrapped: its own fields win. Times
    are in UTC, without a zone. The layout is checked by one pattern; the
    fields are then cut at fixed marks, which is cheaper than a pattern each.
    """
    text = F.col(record)
    head = F.substring_index(text, "\n", 1)
    rest = F.substring(text, F.length(head) + 2, F.length(text))
    own = F.col("_own")
    outer, inner = F.col("_head").rlike(HEADER), _message(F.col("_head")).rlike(HEADER)

    def field(value: Column) -> Column:
        return F.when(F.col("_laid_out"), value)

    # "[time] {module:line} LEVEL - message"
    place = F.substring_index(F.substring_index(own, "} ", 1), "{", -1)
    time = F.substring(F.substring_index(own, "] {", 1), F.lit(2), F.length(own))
    moment = F.try_to_timestamp(field(time), F.lit(TIME)).cast("timestamp_ntz")
    return (
        records.withColumns({"_head": head, "continuation": F.when(text.contains("\n"), rest)})
        .withColumns({"_laid_out": outer, "_own": F.when(outer & inner, _message(F.col("_head"))).otherwise(F.col("_head"))})
        .withColumns(
            {
                "ts": F.convert_timezone(F.current_timezone(), F.lit("UTC"), moment),
                "module": field(F.substring_index(place, ":", 1)),
                "lineno": field(F.substring_index(place, ":", -1)).cast("int"),
                "level": field(F.substring_index(F.substring_index(own, " - ", 1), " ", -1)),
                "message": F.when(F.col("_laid_out"), _message(own)).otherwise(own),
            }
        )
        .drop("_own", "_head", "_laid_out", record)
    )


def _message(header: Column) -> Column:
    return F.substring(header, F.locate(" - ", header) + 3, F.length(header))


def took_seconds(message: Column) -> Column:
    """The trailing measure of a message, NULL if it has none."""
    # An empty text must be gone before the cast, which would raise and catch an error for each.
    found = F.nullif(F.regexp_extract(message, TOOK, 1), F.lit("")).try_cast("double")
    return F.when(message.contains("took "), found)


def source_file(message: Column) -> Column:
    """The pipeline file a message is about."""
    return F.nullif(F.regexp_extract(message, SOURCE_FILE, 1), F.lit(""))


def pipeline_count(message: Column) -> Column:
    """How many pipelines a message lists, NULL if it lists none."""
    listed = F.regexp_extract(message, PIPELINE_LIST, 1)
    names = F.regexp_extract_all(listed, F.lit(QUOTED), F.lit(1))
    return F.when(message.contains("dict_keys([") & message.rlike(PIPELINE_LIST), F.size(names))


def measured(fields: DataFrame) -> DataFrame:
    """Add the source file, the duration and the number of pipelines of each record."""
    message = F.col("message")
    return fields.withColumns(
        {"source": source_file(message), "took": took_seconds(message), "n_pipelines": pipeline_count(message)}
    )


def level_counts(fields: DataFrame, file: str = "file") -> DataFrame:
    """Records per file and level."""
    return fields.groupBy(file, "level").agg(F.count("*").alias("n"))


def file_stats(records: DataFrame, file: str = "source") -> DataFrame:
    """Per file: records, errors, failed imports, pipelines, and the distribution of durations.

    Rows are counted per file and duration first. The exact median then reads
    counts of distinct durations instead of the durations themselves.
    """
    failed = F.col("message").startswith("Failed to import")
    counted = records.groupBy(file, "took").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("level") == "ERROR").alias("errors"),
        F.count_if(F.col("level") == "WARNING").alias("warnings"),
        F.count_if(failed).alias("failed"),
        F.count("continuation").alias("continued"),
        F.max("n_pipelines").alias("n_pipelines"),
    )
    runs = F.when(F.col("took").isNotNull(), F.col("n")).otherwise(0)
    return counted.groupBy(file).agg(
        F.sum("n").alias("n_records"),
        F.sum("errors").alias("n_errors"),
        F.sum("warnings").alias("n_warnings"),
        F.sum("failed").alias("n_failed_imports"),
        F.sum("continued").alias("n_continued"),
        F.coalesce(F.max("n_pipelines"), F.lit(0)).alias("n_pipelines"),
        F.sum(runs).alias("n_runs"),
        F.min("took").alias("min_took"),
        F.max("took").alias("max_took"),
        (F.sum(F.col("took") * F.col("n")) / F.nullif(F.sum(runs), F.lit(0))).alias("mean_took"),
        F.percentile("took", 0.5, F.col("n")).alias("median_took"),
    )


def process_id(message: Column) -> Column:
    """The process that a message says was started, NULL for other messages."""
    return F.nullif(F.regexp_extract(message, STARTED, 1), F.lit("")).cast("long")


def run_spans(records: DataFrame, file: str = "source", hot_rows: int = HOT_ROWS) -> DataFrame:
    """Runs of each file from the records of their start and end: ``file, pid, started, ended, took, state``.

    A run is ``finished`` if the next start or end of its file is an end,
    ``open`` if it is another start or there is none, and an end without a
    start before it is ``unstarted``. Records at one time count starts first,
    then by process and duration. The window is split for files with very many
    records.
    """
    marked = records.withColumn("pid", process_id(F.col("message"))).where(F.col("pid").isNotNull() | F.col("took").isNotNull())
    rows = marked.select(file, "ts", F.col("pid").isNull().alias("ends"), F.coalesce("pid", F.lit(-1)).alias("pid"), F.coalesce("took", F.lit(-1.0)).alias("took"))
    # Stored, so that the records are parsed once for the three passes that follow.
    rows = durable(rows, "run-marks").withColumn("here", F.struct("ts", "ends", "pid", "took"))
    order = ["ts", "ends", "pid", "took"]
    placed = with_previous(rows, [file], order, "here", "before", hot_rows)
    started = ~F.col("before.ends")
    nothing = F.lit(None).cast("timestamp_ntz")

    def run(start: Column, end: Column, took: Column, pid: Column, state: str) -> Column:
        return F.struct(pid.alias("pid"), start.alias("started"), end.alias("ended"), took.alias("took"), F.lit(state).alias("state"))

    none, no_pid = F.lit(None).cast("double"), F.lit(None).cast("long")
    finished = F.when(F.col("ends") & started, run(F.col("before.ts"), F.col("ts"), F.col("took"), F.col("before.pid"), "finished"))
    unstarted = F.when(F.col("ends"), run(nothing, F.col("ts"), F.col("took"), no_pid, "unstarted"))
    left_open = F.when(~F.col("ends") & started, run(F.col("before.ts"), nothing, none, F.col("before.pid"), "open"))
    closed = placed.select(file, F.coalesce(finished, unstarted, left_open).alias("run")).where(F.col("run").isNotNull())
    last = rows.groupBy(file).agg(F.max("here").alias("here")).where(~F.col("here.ends"))
    still = last.select(file, run(F.col("here.ts"), nothing, none, F.col("here.pid"), "open").alias("run"))
    return closed.unionByName(still).select(file, "run.*")


def latest_runs(records: DataFrame, file: str = "source", ties: list[str] | None = None) -> DataFrame:
    """Per file: the last record with a duration. ``ties`` decides between equal times.

    Records without a duration are passed over in the aggregate. A filter
    before it would be moved below the parsing and repeat it.
    """
    order = F.when(F.col("took").isNotNull(), F.struct("ts", *(ties or ["took"])))
    runs = records.groupBy(file).agg(F.max_by(F.struct("ts", "took"), order).alias("last"))
    return runs.where(F.col("last").isNotNull()).select(
        file, F.col("last.ts").alias("last_run"), F.col("last.took").alias("last_took")
    )


def in_listing_order(stats: DataFrame, file: str = "source") -> DataFrame:
    """Files with few pipelines first; among them those with most errors."""
    return stats.orderBy("n_pipelines", F.desc("n_errors"), file)
