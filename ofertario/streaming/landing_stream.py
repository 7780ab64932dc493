"""The landing zone as a stream: new files appended per micro-batch.

Each batch leaves its own newest record per offer id, under its batch id; reading
takes the newest over all batches. So a batch costs what it holds, a replayed batch
replaces itself, and the content after any split into batches equals one batch load
of the same files. ``stream_fact`` brings the result on to the fact table.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality
from ..operators.conform import keep_worth_showing
from ..operators.dedup import dedup_by_source, latest_by, newest_first
from ..operators.merge import fact_columns
from ..operators.normalize import NORMALIZERS
from ..plans.build import normalised, raw_checks, staged, without_payload
from ..sources.landing import SCHEMA, usable
from ..sources.tables import read_batches, write_batch, write_version


def read_landing_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def append_newest(batch: DataFrame, table: str, batch_id: int, tie_path: str | None = None) -> None:
    """The newest records of the batch, and its raw checks, as a part of the table."""
    raw, seen = batch, []
    for spider in NORMALIZERS:
        checks = raw_checks(spider)
        of_spider = F.col("spider") == spider
        own = [replace(c, where=of_spider if c.where is None else c.where & of_spider) for c in checks]
        raw, observation = quality.observed(raw, own, f"raw_{spider}")
        seen.append((spider, observation, own))
    staging = without_payload(keep_worth_showing(staged(usable(raw))), tie_path)
    write_batch(dedup_by_source(staging), table, batch_id)
    spark = batch.sparkSession
    reports = [
        quality.observed_report(spark, observation, own).withColumn("of", F.lit(f"raw_{spider}"))
        for spider, observation, own in seen
    ]
    write_batch(reduce(lambda a, b: a.unionByName(b), reports).coalesce(1), f"{table}-checks", batch_id)


def read_newest(spark: SparkSession, table: str) -> DataFrame | None:
    """The newest record of every offer id; None before the first batch."""
    rows = read_batches(spark, table)
    return None if rows is None else latest_by(rows, ["discount_id"], newest_first())


def streamed_checks(spark: SparkSession, table: str) -> DataFrame | None:
    """The raw checks of all batches: of, check, column, failing, total."""
    rows = read_batches(spark, f"{table}-checks")
    if rows is None:
        return None
    return rows.groupBy("of", "check", "column").agg(
        F.sum("failing").alias("failing"), F.sum("total").alias("total")
    )


def compact(spark: SparkSession, table: str, path: str) -> int:
    """The newest records as a version of the table at ``path``."""
    return write_version(read_newest(spark, table), path, "compacted")


def start_landing_stream(
    stream: DataFrame, table: str, checkpoint: str, tie_path: str | None = None
) -> StreamingQuery:
    """Takes in all files present, then stops; one query per table at a time."""

    def take_in(batch: DataFrame, batch_id: int) -> None:
        append_newest(batch, table, batch_id, tie_path)

    return (
        stream.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def streamed_offers(
    spark: SparkSession,
    table: str,
    overrides: DataFrame | None = None,
    categories: DataFrame | None = None,
) -> DataFrame | None:
    """Normalised offers from the table the stream keeps."""
    newest = read_newest(spark, table)
    return None if newest is None else normalised(newest, overrides, categories)


def stream_fact(
    spark: SparkSession,
    table: str,
    path: str,
    overrides: DataFrame | None = None,
    categories: DataFrame | None = None,
    keep: int | None = None,
) -> int | None:
    """The fact table from all that was taken in, as its next version.

    Duplicates by content span batches, so the fact follows from the newest records
    as a whole, after a run of the stream and not in every batch.
    """
    offers = streamed_offers(spark, table, overrides, categories)
    return None if offers is None else write_version(fact_columns(offers), path, "stream", keep)
