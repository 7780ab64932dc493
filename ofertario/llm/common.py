"""Helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import math
import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ofertario.session import scratch, written
from ofertario.sources.tables import remove

#: The bytes that end a word: space and 0x09 to 0x0D, as bytes.split() has them.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of texts that go to Python at once, and Spark's bound of them.
TEXT_BATCH, BATCH_BYTES = 1 << 21, "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buckets_for(rows: int) -> int:
    """About the square root: as many buckets as rows in each."""
    return max(1, math.isqrt(rows))


def hash_bucket(h: Column, buckets: int) -> Column:
    """The bucket of a 64-bit hash; it grows with the hash."""
    return F.floor((h / F.lit(2.0**64) + 0.5) * F.lit(buckets)).cast("long")


def sum_before(
    df: DataFrame, keys: list[str], bucket: str, order: list, value: str, name: str
) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over earlier rows of the same keys.

    Earlier means a smaller ``bucket``, or the same one and smaller by ``order``.
    ``bucket`` must not contradict the wanted order. A hot key is spread over its
    buckets: only one number per key and bucket meets in one task. Keys must not
    be null. ``df`` is read twice and must be stable (written).
    """
    first = Window.unboundedPreceding
    sums = df.groupBy(*keys, bucket).agg(F.sum(value).alias("__sum"))
    over_buckets = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(first, -1)
    starts = sums.select(
        *keys, bucket, F.coalesce(F.sum("__sum").over(over_buckets), F.lit(0)).alias("__start")
    )
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(first, -1)
    return (
        df.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(starts, [*keys, bucket])
        .withColumn(name, F.col("__start") + F.col("__inside"))
        .drop("__start", "__inside")
    )


@contextmanager
def kept_last():
    """Gives a function that writes a frame; of all that is written meanwhile only what went
    through it stays, the other intermediates are removed at the end."""
    folders: list[str] = []
    stays: list[DataFrame] = []

    def last(df: DataFrame) -> DataFrame:
        stays.append(df.sparkSession)
        kept = written(df, "result")
        stays.append(folders.pop())
        return kept

    with scratch(folders):
        yield last
    for folder in folders if stays else []:
        remove(stays[0], folder)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of frames that nothing refers to any more.

    It does so when the driver collects its garbage, which may be long after a large
    shuffle has been written out and is of no use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_texts(df: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow`` over rows with whole texts, in batches of at most ``TEXT_BATCH`` bytes.

    Spark counts rows, 10,000 a batch unless told otherwise, and each running task holds a
    batch several times: in the JVM's buffers, in Python's, and as Python's own strings. A
    smaller bound of the session stays; the bound holds for the session from then on, as the
    frame may be run later.
    """
    conf = df.sparkSession.conf
    now = re.fullmatch(r"(\d+)([kmgtp]?)b?", conf.get(BATCH_BYTES).strip().lower())
    if not now or not 0 < int(now[1]) << 10 * " kmgtp".index(now[2] or " ") <= TEXT_BATCH:
        conf.set(BATCH_BYTES, str(TEXT_BATCH))
    return df.mapInArrow(function, schema)


def only(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns under plain names; other columns cannot clash."""
    return df.select(*[df[f"`{c}`"].alias(name) for name, c in columns.items()])
