"""Scaling, class balance, weights and splits of training data."""

from __future__ import annotations

from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from monthmill.operators.lookups import attach_group_values
from monthmill.operators.ordered import row_numbers
from monthmill.session import durable

# Fixed value: the weight of the positive class.
SCALE_POS_WEIGHT = 0.35

# Four hexadecimal digits of an md5 cut a class into 65,536 even parts.
_PREFIX = 4


def standard_scale(df: DataFrame, columns: list[str], suffix: str = "_std") -> DataFrame:
    """Add ``(x - mean) / sample stddev`` of each column; 0 where the column is constant."""
    stats = _column_stats(df, columns, {"mean": F.mean, "spread": F.stddev_samp})

    def scaled(c: str) -> Column:
        moved = (F.col(c) - stats[c]["mean"]) / F.nullif(stats[c]["spread"], F.lit(0))
        return F.when(F.col(c).isNotNull(), F.coalesce(moved, F.lit(0.0)))

    return df.withColumns({c + suffix: scaled(c) for c in columns})


def minmax_scale(df: DataFrame, columns: list[str], suffix: str = "_norm") -> DataFrame:
    """Add each column moved to [0, 1]; 0 where the column is constant."""
    stats = _column_stats(df, columns, {"low": F.min, "high": F.max})

    def scaled(c: str) -> Column:
        low, width = stats[c]["low"], stats[c]["high"] - stats[c]["low"]
        return F.when(F.col(c).isNotNull(), F.coalesce((F.col(c) - low) / F.nullif(width, F.lit(0)), F.lit(0.0)))

    return df.withColumns({c + suffix: scaled(c) for c in columns})


def _column_stats(df: DataFrame, columns: list[str], kinds: dict) -> Column:
    """One row of statistics as a scalar subquery: no join, and nothing passes the driver."""
    per_column = [
        F.struct(*[kind(c).alias(name) for name, kind in kinds.items()]).alias(c) for c in columns
    ]
    return df.agg(F.struct(*per_column).alias("stats")).scalar()


def class_counts(df: DataFrame, klass: str) -> DataFrame:
    """Rows per class, stored, since the size of the table decides how it is joined."""
    return durable(df.groupBy(klass).agg(F.count("*").alias("n")))


def upsample(df: DataFrame, klass: str) -> DataFrame:
    """Repeat each row ``floor(largest class / own class)`` times, numbered in ``copy`` from 1."""
    counts = class_counts(df, klass)
    times = counts.withColumn("_times", F.floor(counts.agg(F.max("n")).scalar() / F.col("n")).cast("int")).drop("n")
    joined = attach_group_values(df, times, [klass])
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times")


def balance(df: DataFrame, klass: str, row_id: str) -> DataFrame:
    """Cut every class to the size of the smallest."""
    return pick_per_class(df, klass, row_id, None)


def pick_per_class(df: DataFrame, klass: str, row_id: str, rows: int | None) -> DataFrame:
    """The ``rows`` rows of each class with the smallest md5 of their id, all of smaller classes.

    ``rows`` is the size of the smallest class if not given; ``row_id`` must be unique.
    Classes are large, so they are not sorted: counts per leading digits of the
    md5 tell which parts are kept whole. Only the one part in which a class's
    cut lies, 1/65,536 of the class, is ranked row by row, in chunks if it is large.
    """
    tag = F.md5(F.col(row_id).cast("string"))
    tagged = df.withColumn("_tag", tag).withColumn("_part", F.substring("_tag", 1, _PREFIX))
    parts = durable(tagged.groupBy(klass, "_part").agg(F.count("*").alias("n")))
    if rows is None:
        sizes = parts.groupBy(klass).agg(F.sum("n").alias("n"))
        wanted = sizes.agg(F.min("n")).scalar()
    else:
        wanted = F.lit(rows)
    so_far = Window.partitionBy(klass).orderBy("_part")
    cuts = (
        parts.withColumn("_end", F.sum("n").over(so_far))
        .withColumn("_wanted", wanted)
        .where((F.col("_end") > F.col("_wanted")) & (F.col("_end") - F.col("n") <= F.col("_wanted")))
        .select(klass, F.col("_part").alias("_cut"), (F.col("_wanted") - F.col("_end") + F.col("n")).alias("_left"))
    )
    placed = attach_group_values(tagged, durable(cuts), [klass])
    whole = placed.where(F.col("_cut").isNull() | (F.col("_part") < F.col("_cut")))
    # Small, and read twice where it is ranked. A plain ``==`` would have the md5 taken twice, once to see that it is not null.
    edge = durable(placed.where(F.col("_cut").isNotNull() & F.col("_part").eqNullSafe(F.col("_cut"))), "edge")
    ranked = row_numbers(edge, [klass], [F.col("_tag"), F.col(row_id)], "_rank")
    kept = ranked.where(F.col("_rank") <= F.col("_left"))
    return whole.select(*df.columns).unionByName(kept.select(*df.columns))


def with_class_weight(df: DataFrame, label: str, weight: float = SCALE_POS_WEIGHT) -> DataFrame:
    """Add ``weight``: the given value for the positive class, 1 for the rest."""
    return df.withColumn("weight", F.when(F.col(label) == 1, weight).otherwise(1.0))


def training_rows(
    df: DataFrame, label: str, row_id: str, upsampled: bool = False, balanced: bool = False, weight: float | None = None
) -> DataFrame:
    """The rows a training gets by its options: small classes repeated, all cut to the smallest, the positive one weighted."""
    rows = upsample(df, label).drop("copy") if upsampled else df
    rows = balance(rows, label, row_id) if balanced else rows
    return rows if weight is None else with_class_weight(rows, label, weight)


def with_split(df: DataFrame, row_id: str, train_percent: int = 80) -> DataFrame:
    """Add ``part``, train or test. It depends on the id alone, so a row never changes sides."""
    digits = F.substring(F.md5(F.col(row_id).cast("string")), 1, 8)
    bucket = F.conv(digits, 16, 10).cast("long") % 100
    return df.withColumn("part", F.when(bucket < train_percent, "train").otherwise("test"))


def principal_components(df: DataFrame, vector: str, k: int) -> tuple[DataFrame, PCAModel]:
    """Add ``pc_1 .. pc_k`` of a vector column, and return the fitted model. Signs are arbitrary."""
    model = PCA(k=k, inputCol=vector, outputCol="_pc").fit(df)
    scores = model.transform(df).withColumn("_pc", vector_to_array("_pc"))
    return scores.withColumns({f"pc_{i + 1}": F.col("_pc")[i] for i in range(k)}).drop("_pc"), model
