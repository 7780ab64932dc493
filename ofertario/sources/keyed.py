"""Tables in one folder per hash bucket of a key, plain parquet partitions.

A change reads and rewrites the folders of the keys it touches and no other; only those
are listed. Writing is Spark's dynamic partition overwrite. The number of buckets is part
of the partition column's name, so a table is never read with another one.

A bucket is replaced whole when the write commits. A run that dies while it commits leaves
some buckets new and some old; the same change applied again gives the same table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import written
from .tables import exists, remove


def _folder(buckets: int) -> str:
    return f"bucket_of_{buckets}"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that hold some of these keys; at most ``buckets`` numbers."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets)).distinct().collect())


def read_keyed(
    spark: SparkSession, path: str, schema, buckets: int, only: list[int] | None = None
) -> DataFrame:
    """The rows of the table, or of the named buckets; none before the first write."""
    name = _folder(buckets)
    if only is None:
        folders = [path] if exists(spark, path) else []
    else:
        folders = [f for f in (f"{path}/{name}={b}" for b in only) if exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).drop(name)


def replace_buckets(
    rows: DataFrame, path: str, key: str, buckets: int, touched: list[int], files: int = 1, spread: str | None = None
) -> None:
    """The touched buckets hold exactly ``rows`` from now on, which must lie in them.

    ``rows`` may read the table. Each bucket is written by ``files`` tasks; ``spread`` names
    a column to deal its rows by where many share a key.
    """
    name, spark = _folder(buckets), rows.sparkSession
    fresh = written(rows.withColumn(name, bucket_of(key, buckets)), "buckets")
    share = F.pmod(F.xxhash64(spread or key, F.lit(1)), F.lit(files))
    (
        fresh.repartition(name, share)
        .write.partitionBy(name)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )
    left = {r[0] for r in fresh.select(name).distinct().collect()}
    for bucket in set(touched) - left:
        remove(spark, f"{path}/{name}={bucket}")


def upsert_keyed(incoming: DataFrame, path: str, key: str = "id", buckets: int = 64, files: int = 1) -> list[int]:
    """Incoming rows, one per key, replace those of their keys; the buckets rewritten."""
    incoming = written(incoming, "incoming")
    touched = touched_buckets(incoming, key, buckets)
    if touched:
        old = read_keyed(incoming.sparkSession, path, incoming.schema, buckets, touched)
        kept = old.join(incoming.select(key), key, "left_anti")
        replace_buckets(kept.unionByName(incoming), path, key, buckets, touched, files)
    return touched
