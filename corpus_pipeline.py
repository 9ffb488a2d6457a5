"""From documents to a training mix: five stages, each over all rows that the one before kept.

Every row is a document of its own, also where doc_id repeats or is null. An
empty table passes all stages as one. Extra columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.llm import decontaminate, langid, lines, mixing, simhash
from monthmill.llm.tables import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found with enough certainty; texts that are null or without letters go."""
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of 40 and more characters that 5 or more of them share; n_chars follows the text."""
    found = lines.drop_repeated_lines(docs, least=40, documents=5)
    changed = F.col("n_dropped") > 0
    return found.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of 3 words, at most 3 differing bits."""
    return simhash.without_near_duplicates(docs, shingle=3, bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of 10 words of a benchmark item; texts without words stay."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), length=10)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: each document as often as it is taken, numbered by epoch. Null texts have size 0, null sources are one source."""
    return mixing.mixed(docs, weights=(5, 2, 1), share=1.5, most=2.0)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_dedup),
    ("benchmark decontamination", decontamination),
    ("source mixing", mix),
]

#: The first stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are stored before the next one reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
