"""Job names and seeded draws."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The prefixes of the job names of a monthly cycle.
JOB_PREFIXES = {
    "label": "demographic_label_generation",
    "train": "demographic_training",
    "predict": "demographic_prediction",
}


def job_name(step: str, market: Column, month: Column, model_type: Column | None = None) -> Column:
    """``prefix_market[_type]_yyyymm``."""
    parts = [F.lit(JOB_PREFIXES[step]), market]
    if model_type is not None:
        parts.append(model_type)
    return F.concat_ws("_", *parts, month)


def random_integer(seed: int, low: int = 1, high: int = 10) -> Column:
    """A uniform integer between ``low`` and ``high``, both ends included."""
    return (F.floor(F.rand(seed) * (high - low + 1)) + low).cast("int")
