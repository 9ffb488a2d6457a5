"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: The largest table, in bytes, that is sent to every executor.
BROADCAST_BYTES = 32 << 20


def local_session(name: str, cores: str | int = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. Clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    A checkpoint folder that the caller has set already is used as well. Only a local master may go without the setting; it then gets a temporary
    folder of its own.
    """
    context = spark.sparkContext
    chosen = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if chosen is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        chosen = tempfile.mkdtemp(prefix="monthmill-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(chosen)
    return spark.conf.get("spark.checkpoint.dir", None) or chosen


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str = "stored") -> DataFrame:
    """Compute ``df`` once and keep it as Parquet in the shared folder, so lost executors cost nothing."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def measured_bytes(df: DataFrame) -> int:
    """The size of all rows of a stored table as text, with a charge per row for the hash table it may go into."""
    width = F.octet_length(F.to_json(F.struct("*"))) + 64
    return df.agg(F.sum(width)).first()[0] or 0


def small_side(stored: DataFrame) -> DataFrame:
    """A stored table as one side of a join: broadcast if its measured size allows, else left to Spark."""
    return F.broadcast(stored) if measured_bytes(stored) <= BROADCAST_BYTES else stored
