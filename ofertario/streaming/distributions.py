"""Distributions of a stream of measured values, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.metrics import windowed_histogram


def streaming_histogram(
    values: DataFrame, groups: list[str], time: str = "ts", lateness: str = "10 minutes", **options
) -> DataFrame:
    """Bucket counts by window of event time; state goes once a window is ``lateness`` old.

    In append mode each window's counts come once, when it is closed, and later values are
    dropped; in update mode they come as they grow.
    """
    return windowed_histogram(values.withWatermark(time, lateness), groups, time=time, **options)


def merged_histogram(windows: DataFrame, groups: list[str]) -> DataFrame:
    """The histogram over windows of any number: bucket counts add up."""
    return windows.groupBy(*groups, "bucket").agg(F.sum("n").alias("n"))
