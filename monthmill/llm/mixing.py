"""Mixing sources to target weights with hash-random keys and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.tables import numbered, small_side, stored

#: Rows per interval of keys, on average; each interval is one group of a window.
INTERVAL = 2_000


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Adds ``target`` to a table (source, source_size, rows) with one row per source.

    Sources in order of code points, null last, weigh ``weights`` in turn and
    share ``share`` times all sizes. A target stops at ``most`` times its
    source's size and the excess is shared anew by weight until none is above:
    with sources in order of the level at which they are full, the common level
    is the first that leaves the next source unfilled. The table has a row per
    source, so its windows run over sources, never over documents.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    full = sizes.withColumn("weight", weight).withColumn("full", F.lit(float(most)) * F.col("source_size")).withColumn("at", F.col("full") / F.col("weight"))
    before = Window.orderBy("at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("at", F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    leveled = full.withColumn("level", rest / F.sum("weight").over(onward))
    level = F.min(F.when(F.col("level") <= F.col("at"), F.struct("at", "level"))).over(every)["level"]
    return leveled.withColumn("target", F.when(level.isNull(), F.col("full")).otherwise(F.least("full", F.col("weight") * level))).select(*sizes.columns, "target")


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0, *, key: str = "doc_id", text: str = "text", source: str = "source", row: str | None = None) -> DataFrame:
    """How much of each document a mix takes: rows (key, source, size, source_size, target, taken, row_key), one per document.

    Size is the number of words. Each document gets a hash-random key of its
    identifier and text; sources are cut into intervals of keys of about
    ``INTERVAL`` rows, sorted within, and summed up by prefix over intervals and
    then over rows, so a hot source spreads over many tasks. A source repeats
    whole while its budget allows, then takes documents in key order up to the
    remaining budget: whole documents, the last one if its half fits. ``taken``
    counts words with repeats, at most ``most`` (rounded up) times the size.

    Null texts have size 0; null sources are one source. Rows that repeat one
    identifier and text are separate rows that share a key; ``row``, a column
    that numbers the rows, puts them in order and is returned as ``row``. An
    empty table gives an empty table. Reruns agree.
    """
    random = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col(text)).cast("binary"))
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    sized = stored(docs.select(F.col(key).alias("_id"), F.col(source).alias("source"), words.alias("size"), random.alias("row_key"), (F.col(row) if row else F.lit(0).cast("long")).alias("row")), "sizes")
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    targets = stored(source_targets(totals, weights, share, most).withColumn("intervals", F.ceil(F.col("n") / INTERVAL)), "targets")
    place = (F.conv(F.substring("row_key", 1, 8), 16, 10).cast("double") / float(1 << 32) * F.col("intervals")).cast("long")
    same = sized["source"].eqNullSafe(targets["source"])
    placed = sized.join(targets, same).select("_id", sized["source"], "size", "row_key", "row", "source_size", "target", place.alias("interval"))
    intervals = placed.groupBy("source", "interval").agg(F.sum("size").alias("words"))
    ahead = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = intervals.select(F.col("source").alias("_source"), F.col("interval").alias("_interval"), ahead.alias("_ahead"))
    within = F.coalesce(F.sum("size").over(Window.partitionBy("source", "interval").orderBy("row_key", "_id", "size", "row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = placed.withColumn("within", within).join(starts, F.col("source").eqNullSafe(F.col("_source")) & (F.col("interval") == F.col("_interval")))
    whole = F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
    left = F.col("target") - whole * F.col("source_size")
    # Where nothing is left, rows of size 0 are not taken once more either.
    once_more = ((left > 0) & (F.col("_ahead") + F.col("within") + F.col("size") / 2 <= left)).cast("long")
    return sums.select(F.col("_id").alias(key), "source", "size", "source_size", "target", ((whole + once_more) * F.col("size")).alias("taken"), "row_key", "row", whole.alias("whole"), (whole + once_more).alias("copies"))


def mixed(docs: DataFrame, *args, key: str = "doc_id", text: str = "text", source: str = "source", seed: int = 0, **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` that ``mix`` takes, each as often as it is taken, with ``epoch`` from 1 on.

    The rows are stored with a number. In the order of keys, and of these
    numbers among equal keys, a source is taken once more up to a cut, so a
    row per source says what becomes of a document, and texts are not moved.
    Each row of one identifier and text is decided by itself: the mix has
    exactly the copies of ``mix``. Documents without words are taken like
    others at the place of their key. A column named epoch is replaced, all
    others are kept as they are.
    """
    rows, row = numbered(docs)
    plan = mix(rows, *args, key=key, text=text, source=source, seed=seed, row=row, **options)
    order = F.struct("row_key", "row")
    cuts = plan.groupBy("source").agg(F.max("whole").alias("whole"), F.max(F.when(F.col("copies") > F.col("whole"), order)).alias("cut"))
    cuts = small_side(stored(cuts, "cuts").select(F.struct("source", "whole", "cut").alias(f"{row}cut")), 256)
    random = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"), F.col(text)).cast("binary"))
    own = [c for c in docs.columns if c != "epoch"]
    joined = rows.join(cuts, F.col(source).eqNullSafe(F.col(f"{row}cut.source")))
    here = F.struct(random.alias("row_key"), F.col(row).alias("row"))
    copies = F.col(f"{row}cut.whole") + F.coalesce(here <= F.col(f"{row}cut.cut"), F.lit(False)).cast("long")
    # A sequence of no copies would count down.
    epochs = F.when(copies > 0, F.sequence(F.lit(1), copies.cast("int"))).otherwise(F.array().cast("array<int>"))
    return joined.select(*own, F.explode(epochs).alias("epoch"))
