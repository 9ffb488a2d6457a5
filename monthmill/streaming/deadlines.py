"""Waiting for partitions with a deadline: what is missing is reported when its time is over, and taken back if it comes late."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

REPORT = "partition string, state string, deadline timestamp"
STATE = "deadline long, arrived boolean, reported boolean"


def _follow(key: tuple, notes: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """One partition: its notes in any order, and the timer at its deadline (milliseconds; -1 while it is not known)."""
    deadline, arrived, reported = state.get if state.exists else (-1, False, False)
    said = []
    for part in notes:
        due = part.loc[part["kind"] == "expected", "due"].dropna()
        # Of several deadlines the earliest counts.
        deadline = min([int(d) for d in due] + ([deadline] if deadline >= 0 else []), default=-1)
        arrived = arrived or bool((part["kind"] == "arrived").any())
    over = deadline >= 0 and (state.hasTimedOut or deadline <= state.getCurrentWatermarkMs())
    if arrived and reported:
        said, reported = ["withdrawn"], False
    elif over and not arrived and not reported:
        said, reported = ["missing"], True
    state.update((deadline, arrived, reported))
    if deadline >= 0 and not arrived and not reported:
        state.setTimeoutTimestamp(deadline)
    at = pd.Timestamp(deadline, unit="ms") if deadline >= 0 else pd.NaT
    yield pd.DataFrame({"partition": [key[0]] * len(said), "state": said, "deadline": pd.Series([at] * len(said), dtype="datetime64[ns]")})


def missing_after_deadline(notes: DataFrame, delay: str = "0 seconds") -> DataFrame:
    """``partition, state, deadline`` from a stream of notes ``partition, kind, at, due``.

    A note says at time ``at`` that a partition is ``expected`` by ``due``, or
    that it has ``arrived``. Once the stream's time, the newest ``at`` less
    ``delay``, has passed the deadline, a partition that has not arrived is
    reported as ``missing``, once; if it arrives later, as ``withdrawn``. What
    arrives before it is expected, or in time, is not reported. A state of
    three values is kept per partition; notes that come after the deadline are
    not dropped.
    """
    typed = notes.select("partition", "kind", F.col("at").cast("timestamp").alias("at"), F.unix_millis(F.col("due").cast("timestamp")).alias("due"))
    keyed = typed.withWatermark("at", delay).groupBy("partition")
    return keyed.applyInPandasWithState(_follow, REPORT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def still_missing(reports: DataFrame) -> DataFrame:
    """The partitions of stored reports that are missing and not taken back."""
    change = F.when(F.col("state") == "missing", 1).otherwise(-1)
    return reports.groupBy("partition").agg(F.sum(change).alias("n"), F.max("deadline").alias("deadline")).where("n > 0").drop("n")
