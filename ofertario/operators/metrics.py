"""Run statistics from log lines, their distributions, and failure alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.jsonx import json_value
from ..functions.scalars import safe_double

# The marker of a statistics line and the numbers taken from it.
MARKER = "WORKFLOW_STATS"
METRICS = {
    "items_scraped": "$['item_scraped_count']",
    "elapsed_seconds": "$['elapsed_time_seconds']",
    "responses_per_minute": "$['responses_per_minute']",
    "items_per_minute": "$['items_per_minute']",
    "responses_403": "$['response_status_count/403']",
}

# The buckets of a distribution.
FINITE_BUCKETS = 64
GROWTH = 2.0
SCALE = 1.0


def run_stats(lines: DataFrame, text: str = "value") -> DataFrame:
    """spider and five metrics per statistics line; other columns are kept.

    The JSON after the marker is parsed, so a ``null`` metric is NULL rather
    than the next number of the line. Lines without an object are left out.
    """
    marked = lines.filter(F.col(text).contains(MARKER))
    body = F.regexp_extract(text, rf"(?s){MARKER}\s*(\{{.*\}})", 1)
    parsed = marked.withColumn("_stats", F.try_parse_json(F.nullif(body, F.lit(""))))
    return (
        parsed.filter(F.col("_stats").isNotNull())
        .withColumn("spider", json_value("_stats", "$.spider"))
        .withColumns({n: safe_double(json_value("_stats", p)) for n, p in METRICS.items()})
        .drop("_stats", text)
    )


def long_metrics(stats: DataFrame) -> DataFrame:
    """(spider, metric, value), known values only."""
    entries = F.array(
        *[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    )
    return stats.select("spider", F.inline(entries)).filter(F.col("value").isNotNull())


def bucket_of(
    value, finite: int = FINITE_BUCKETS, growth: float = GROWTH, scale: float = SCALE
) -> Column:
    """Bounds at or below the value: 0 is underflow, ``finite + 1`` overflow."""
    value = F.col(value) if isinstance(value, str) else value
    bounds = F.array(*[F.lit(scale * growth**i) for i in range(finite + 1)])
    return F.array_size(F.filter(bounds, lambda b: b <= value))


def histogram(values: DataFrame, groups: list[str], value: str = "value", **buckets) -> DataFrame:
    """How many values of each group fall into each exponential bucket."""
    return (
        values.filter(F.col(value).isNotNull())
        .withColumn("bucket", bucket_of(value, **buckets))
        .groupBy(*groups, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def windowed_histogram(
    values: DataFrame, groups: list[str], time: str = "ts", window: str = "1 hour", value: str = "value", **buckets
) -> DataFrame:
    """``histogram`` for each window of event time; counts of windows add up to it.

    The same plan serves a table and a stream; see ``streaming.distributions``.
    """
    return (
        values.filter(F.col(value).isNotNull())
        .withColumn("bucket", bucket_of(value, **buckets))
        .groupBy(F.window(time, window), *groups, "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), *groups, "bucket", "n")
    )


def failure_alerts(
    runs: DataFrame,
    time: str = "ts",
    workflow: str = "workflow_id",
    status: str = "status",
    failed: str = "FAILED",
    window: str = "60 seconds",
    threshold: int = 0,
) -> DataFrame:
    """Windows in which a workflow failed more than ``threshold`` times.

    The same plan serves a table and a stream; see ``streaming.alerts``.
    """
    return (
        runs.filter(F.col(status) == failed)
        .groupBy(F.window(time, window), F.col(workflow).alias("workflow_id"))
        .agg(F.count(F.lit(1)).alias("failures"))
        .filter(F.col("failures") > threshold)
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "workflow_id",
            "failures",
        )
    )


def items_per_category(raw: DataFrame, category: Column) -> DataFrame:
    """The run counters: items per source and category."""
    return raw.groupBy("spider", category.alias("category")).agg(
        F.count(F.lit(1)).alias("items")
    )


def run_summary(executions: DataFrame, new_files: DataFrame, build_id: str) -> DataFrame:
    """One record per source: its execution, its new files, the build."""
    return executions.join(new_files, "spider", "left").select(
        F.lit(build_id).alias("build_id"),
        "spider",
        "execution",
        F.coalesce("new_files", F.lit(0)).alias("new_files"),
    )


def append_run_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("append").json(path)
