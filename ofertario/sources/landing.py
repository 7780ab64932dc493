"""The landing zone: JSON lines under ``spider=…/scraped_at_dt=…`` folders."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.jsonx import has_content

SCHEMA = "raw_payload variant, spider string, scraped_at_dt date"
PARTITIONS = ["spider", "scraped_at_dt"]


def read_landing(
    spark: SparkSession,
    path: str,
    spider: str | list[str] | None = None,
    since: dt.date | None = None,
    until: dt.date | None = None,
) -> DataFrame:
    """Raw records of the chosen partitions; reading all of them is refused.

    A line that is not JSON gives a NULL payload; see ``usable`` and ``rejects``.
    """
    if spider is None and since is None and until is None:
        raise ValueError("name a spider or a date range: the landing zone is never read whole")
    raw = spark.read.schema(SCHEMA).json(path)
    if spider is not None:
        raw = raw.filter(F.col("spider").isin(spider if isinstance(spider, list) else [spider]))
    if since is not None:
        raw = raw.filter(F.col("scraped_at_dt") >= F.lit(since))
    if until is not None:
        raw = raw.filter(F.col("scraped_at_dt") <= F.lit(until))
    return raw


def store_payloads(raw: DataFrame, path: str) -> None:
    """Raw records as parquet, by source and day; the table's former records are replaced.

    Spark shreds the payloads: fields that records share become columns of their own, so
    that a typed path (``variant_get``) is read from its own column and no other. Text
    lines cannot be read that way; store what is read more than once.
    """
    raw.write.partitionBy(*PARTITIONS).mode("overwrite").parquet(path)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def usable(raw: DataFrame) -> DataFrame:
    return raw.filter(has_content("raw_payload"))


def rejects(raw: DataFrame) -> DataFrame:
    """How many records of each source and day have no payload."""
    return (
        raw.filter(~has_content("raw_payload"))
        .groupBy(*PARTITIONS)
        .agg(F.count(F.lit(1)).alias("rejected"))
    )


def write_landing(df: DataFrame, path: str, files_per_folder: int | None = None) -> None:
    """Append payloads as JSON lines; a frame without rows writes no file.

    Every task writes its own file in each folder it has rows for. With
    ``files_per_folder`` the rows of a folder are first brought to that many
    tasks, by a hash of the payload, so that even a folder with most of the
    rows is written by several. The tasks that made the rows also make their lines;
    the writing ones keep the files of their folders open and sort nothing.
    """
    rows = df.select("raw_payload", *PARTITIONS)
    if not files_per_folder:
        rows.write.partitionBy(*PARTITIONS).mode("append").json(path)
        return
    line, spark = F.to_json(F.struct("raw_payload")).alias("value"), df.sparkSession
    share = F.pmod(F.xxhash64("value"), F.lit(files_per_folder))
    lines = rows.select(line, *PARTITIONS).repartition(*PARTITIONS, share)
    before = spark.conf.get(_OPEN_FILES)
    spark.conf.set(_OPEN_FILES, max(int(before), 256))
    try:
        lines.write.partitionBy(*PARTITIONS).mode("append").text(path)
    finally:
        spark.conf.set(_OPEN_FILES, before)


#: How many files a task may write at a time; at 0 Spark sorts its rows by folder instead.
_OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def new_files(spark: SparkSession, path: str, since: dt.datetime) -> DataFrame:
    """Files written at or after ``since`` (UTC), counted per source.

    Lists files by their metadata; their lines are not read.
    """
    files = spark.read.format("binaryFile").load(path).select(
        F.regexp_extract("path", r"/spider=([^/]*)/", 1).alias("spider"),
        F.col("modificationTime"),
    )
    at = since if since.tzinfo else since.replace(tzinfo=dt.timezone.utc)
    return (
        files.filter(F.col("modificationTime") >= F.lit(at))
        .groupBy("spider")
        .agg(F.count(F.lit(1)).alias("new_files"))
    )


_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def take_new_files(spark: SparkSession, path: str, ledger: str, days: list[dt.date]) -> DataFrame:
    """spider, scraped_at_dt, new_files: files of these days that no earlier call took.

    The ledger is the file source's own log, kept at ``ledger``. Only folders of ``days``
    are listed, so the listing does not grow with the zone; a file of another day is taken
    when its day is asked for. Lines are not read. One call at a time.
    """
    named = ",".join(sorted({day.isoformat() for day in days}))
    counts = f"{ledger}/counts/run={uuid.uuid4().hex}"
    spark.createDataFrame([], _COUNTS).write.parquet(f"{counts}/batch=none")

    def count(batch: DataFrame, number: int) -> None:
        parts = [
            F.regexp_extract("path", r"/spider=([^/]*)/", 1).alias("spider"),
            F.regexp_extract("path", r"/scraped_at_dt=([^/]*)/", 1).cast("date").alias("scraped_at_dt"),
        ]
        counted = batch.groupBy(*parts).agg(F.count(F.lit(1)).alias("new_files"))
        counted.write.mode("overwrite").parquet(f"{counts}/batch={number}")

    if named:
        files = spark.readStream.format("binaryFile").schema(_FILES).load(f"{path}/spider=*/scraped_at_dt={{{named}}}")
        files.select("path").writeStream.foreachBatch(count).option(
            "checkpointLocation", f"{ledger}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(_COUNTS).parquet(counts)
    return found.groupBy("spider", "scraped_at_dt").agg(F.sum("new_files").alias("new_files"))


_COUNTS = "spider string, scraped_at_dt date, new_files bigint"


class NothingNew(RuntimeError):
    """No file arrived since the run began."""


def assert_new_files(spark: SparkSession, path: str, since: dt.datetime) -> dict[str, int]:
    """Counts per source; raises when nothing arrived at all."""
    counts = {r["spider"]: r["new_files"] for r in new_files(spark, path, since).collect()}
    if not counts:
        raise NothingNew(f"no new files in {path} since {since}")
    return counts
