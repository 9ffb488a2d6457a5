"""Text logs whose records may run over several lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from monthmill.operators.ordered import HOT_ROWS, forward_fill, with_previous
from monthmill.session import durable, small_side
from monthmill.sources import logreader

# A record starts with its time in square brackets. The separator opens
# a record; the scan takes it off all records of a file but the first.
SEPARATOR = "\n[2"
FIRST_PIECE = r"^\[2\d{3}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"
LATER_PIECE = r"^\d{3}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}"


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Plain lines of all log files below ``path``: ``file, line``."""
    return (
        spark.read.option("recursiveFileLookup", True)
        .text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    )


def log_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text between separators: ``file, block, place, piece``.

    The files are cut at the record separator, not at line ends, so
    continuation lines stay with their record, large files are still split
    between tasks and nothing is shuffled.
    """
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("lineSep", SEPARATOR)
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias("piece"),
        )
    )


def log_records(spark: SparkSession, path: str) -> DataFrame:
    """Whole records: ``file, record``, the record with its continuation lines.

    The files are read once, by ``logreader``. Paths that only Spark can open
    go through its text source and ``assembled``.
    """
    if logreader.can_open(path):
        return logreader.log_records(spark, path).select("file", "record")
    return assembled(log_pieces(spark, path))


def assembled(pieces: DataFrame) -> DataFrame:
    """``file, record`` from ``file, block, place, piece``.

    A continuation line that itself begins like a separator makes a piece that
    is no record. Only the files that have one are stored and joined again in
    file order; all others go straight through. Times before the year 2000 are
    not recognised.
    """
    piece = F.col("piece")
    stray = pieces.where(~piece.rlike(FIRST_PIECE) & ~piece.rlike(LATER_PIECE))
    files = durable(stray.select("file").distinct(), "stray-files")
    if files.isEmpty():
        return pieces.select("file", restored(piece).alias("record"))
    files = small_side(files)
    whole = pieces.join(files, "file", "left_anti").select("file", restored(piece).alias("record"))
    return whole.unionByName(joined_pieces(durable(pieces.join(files, "file", "left_semi"), "stray-pieces")))


def joined_pieces(pieces: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Attach each piece that starts no record to the last record before it in its file.

    Pieces before the first record of a file have no record to go to and are
    returned as they are, each on its own.
    """
    at = F.struct("block", "place")
    starts = F.col("piece").rlike(FIRST_PIECE) | F.col("piece").rlike(LATER_PIECE)
    placed = pieces.select("file", at.alias("at"), "piece", F.when(starts, at).alias("start"))
    placed = with_previous(placed, ["file"], ["at"], "at", "before", hot_rows)
    whole = F.when(F.col("before").isNull(), F.col("piece")).otherwise(F.concat(F.lit(SEPARATOR[1:]), "piece"))
    owned = forward_fill(placed.withColumn("text", whole), ["file"], ["at"], "start", "owner", hot_rows)
    parts = F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda part: part["text"])
    records = owned.groupBy("file", F.coalesce("owner", "at").alias("owner")).agg(parts.alias("parts"))
    return records.select("file", F.rtrim(F.array_join("parts", "\n"), F.lit("\n")).alias("record"))


def restored(piece: Column) -> Column:
    """A record as it was in the file: only the first of a file still has its bracket."""
    whole = F.when(piece.startswith("["), piece).otherwise(F.concat(F.lit(SEPARATOR[1:]), piece))
    return F.rtrim(whole, F.lit("\n"))
