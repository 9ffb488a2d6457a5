"""All registered queries."""

from __future__ import annotations

from monthmill.plans import cycle, daily, files, jobs, logs, monthly, streams, training  # noqa: F401
from monthmill.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
