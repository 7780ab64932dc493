"""Failure alerts on a stream of finished runs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.metrics import failure_alerts


def streaming_failure_alerts(
    runs: DataFrame, time: str = "ts", lateness: str = "5 minutes", **options
) -> DataFrame:
    """``failure_alerts`` with state dropped once a window is ``lateness`` old.

    Write it in update mode to alert at the first failure of a window, or in
    append mode for one final count per window.
    """
    return failure_alerts(runs.withWatermark(time, lateness), time=time, **options)
