"""Streams over arriving files: windowed statistics and incremental slices."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from monthmill.operators.logs import log_fields, measured
from monthmill.sources.logfiles import SEPARATOR, assembled


def arriving_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    pattern: str | None = None,
    files_per_batch: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """A stream of the files that arrive in a folder."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def arriving_logs(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of the pieces of arriving log files, ``file, block, piece``; ``log_batch`` makes records of a batch."""
    reader = spark.readStream.option("lineSep", SEPARATOR).option("recursiveFileLookup", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.col("_metadata.file_path").alias("file")
    return reader.text(folder).select(file, F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("piece"))


def log_batch(pieces: DataFrame) -> DataFrame:
    """The records of the files of one batch, assembled as in a batch read, with their fields and measures."""
    return measured(log_fields(assembled(pieces.withColumn("place", F.monotonically_increasing_id()))))


def record_batch(records: DataFrame) -> DataFrame:
    """The fields and measures of a batch of ``logreader.arriving_records``."""
    return measured(log_fields(records.select("file", "record")))


#: Batches whose parts are kept before they are merged into a generation.
SLOTS = 32


def fold_available(
    stream: DataFrame,
    moment: str,
    keys: list[str],
    value: str,
    output: str,
    checkpoint: str,
    length: str = "30 seconds",
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
    slots: int | None = None,
) -> None:
    """Add what has arrived to the statistics per key and tumbling window below ``output``, and stop.

    There is no watermark: late rows are one more part, whatever the order of
    the files. Batch ``b`` writes the partial statistics of its own rows to
    slot ``b % slots``; the batch that fills the last slot merges all parts
    and the newest generation into the other one of two generations. So the
    files stay as many, however many batches ran. Parts and generations carry
    the number of the last batch in them: a batch that runs again, before or
    after a merge, counts once, and a merge that fails leaves the generation
    and the parts it was made of. ``folded`` gives the statistics; run it
    between runs of the stream, as slots are written over.
    """
    slots = slots or SLOTS
    typed = None

    def fold(batch: DataFrame, number: int) -> None:
        nonlocal typed
        part = _window_parts(prepare(batch), moment, keys, value, length)
        typed = typed or {k: part.schema[k].dataType.simpleString() for k in keys}
        spark = batch.sparkSession
        newest, upto = _generation(spark, output)
        if number <= upto:
            return
        part.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{output}/parts/slot={number % slots}")
        if number % slots == slots - 1:
            merged = _merged(_live(spark, output, typed), list(keys)).withColumn("batch", F.lit(number).cast("long"))
            merged.write.mode("overwrite").parquet(f"{output}/generations/slot={1 - newest}")

    query = (
        stream.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _generation(spark: SparkSession, output: str) -> tuple[int, int]:
    """(slot, last batch) of the newest generation; (1, -1) if there is none."""
    found = _slots(spark, f"{output}/generations", "batch long").groupBy("slot").agg(F.max("batch").alias("batch")).collect()
    return max(((row.slot, row.batch) for row in found), key=lambda g: g[1], default=(1, -1))


def _slots(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(f"{schema}, slot int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, slot int")


def _live(spark: SparkSession, output: str, keys: dict[str, str]) -> DataFrame:
    """The newest generation and the parts that came after it."""
    typed = ", ".join(f"`{k}` {t}" for k, t in keys.items())
    schema = f"window_start timestamp_ntz, {typed}, n long, total double, largest double, batch long"
    newest, upto = _generation(spark, output)
    whole = _slots(spark, f"{output}/generations", schema).where(F.col("slot") == newest)
    return whole.unionByName(_slots(spark, f"{output}/parts", schema).where(F.col("batch") > upto))


def _merged(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy("window_start", *keys).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("largest").alias("largest")
    )


def folded(spark: SparkSession, output: str, keys: dict[str, str]) -> DataFrame:
    """Rows, sum and maximum per key and window of all that arrived so far. ``keys`` gives the columns' types."""
    return _merged(_live(spark, output, keys), list(keys))


def _window_parts(rows: DataFrame, moment: str, keys: list[str], value: str, length: str) -> DataFrame:
    timed = rows.withColumn("_at", F.col(moment).cast("timestamp")).where(F.col("_at").isNotNull())
    number = F.col(value).cast("double")
    stats = timed.groupBy(F.window("_at", length), *keys).agg(
        F.count("*").alias("n"), F.sum(number).alias("total"), F.max(number).alias("largest")
    )
    return stats.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), *keys, "n", "total", "largest"
    )


def window_stats(
    stream: DataFrame, moment: str, keys: list[str], value: str, length: str = "30 seconds", delay: str = "1 hour"
) -> DataFrame:
    """Rows, sum and maximum per key and tumbling window.

    For sinks that take closed windows only: rows that come later than ``delay``
    behind the newest are dropped and open windows wait. ``fold_available``
    loses nothing.
    """
    timed = stream.withColumn("_at", F.col(moment).cast("timestamp")).withWatermark("_at", delay)
    stats = timed.groupBy(F.window("_at", length), *keys).agg(
        F.count("*").alias("n"), F.sum(value).alias("total"), F.max(value).alias("largest")
    )
    return stats.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"), *keys, "n", "total", "largest"
    )


def run_available(stream: DataFrame, output: str, checkpoint: str) -> None:
    """Process what has arrived, append it to ``output`` and stop.

    The checkpoint remembers what was processed; the next run goes on from there.
    """
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", output)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
