"""Tables as files: full overwrite, and versions for read-then-replace."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_LOG = "version bigint, note string"


def write_table(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``; not for a table ``df`` itself reads."""
    df.write.mode("overwrite").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def current_version(spark: SparkSession, path: str) -> int | None:
    """The newest version whose files were written completely."""
    if not exists(spark, f"{path}/log"):
        return None
    return spark.read.schema(_LOG).json(f"{path}/log").agg(F.max("version")).first()[0]


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The given or current version; None for a table never written."""
    version = current_version(spark, path) if version is None else version
    return None if version is None else spark.read.parquet(f"{path}/version={version}")


def stage_version(df: DataFrame, path: str) -> int:
    """Write ``df``, which may read the current version, as the next one.

    No reader sees it before ``commit_version``; so it can be checked first.
    """
    version = (current_version(df.sparkSession, path) or 0) + 1
    df.write.mode("overwrite").parquet(f"{path}/version={version}")
    return version


def commit_version(
    spark: SparkSession, path: str, version: int, note: str = "", keep: int | None = None
) -> None:
    """Name a staged version in the log; of older ones the last ``keep`` - 1 stay, or all."""
    _log(spark, path, version, note)
    if keep is not None:
        for old in range(version - keep, 0, -1):
            if not remove(spark, f"{path}/version={old}"):
                break


def write_version(df: DataFrame, path: str, note: str = "", keep: int | None = None) -> int:
    """Stage and commit in one.

    Readers follow the log, and the log names a version only after its files
    are complete. A run that dies in between leaves files no reader sees, and
    the next run overwrites them. One writer at a time.
    """
    version = stage_version(df, path)
    commit_version(df.sparkSession, path, version, note, keep)
    return version


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """``df`` as the part ``batch`` of a table; a replay overwrites its own part only."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")
    _log(df.sparkSession, path, batch, "batch")


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    """All completed parts of a table written in batches; None before the first."""
    if not exists(spark, f"{path}/log"):
        return None
    known = spark.read.schema(_LOG).json(f"{path}/log").select(F.col("version").alias("batch")).distinct()
    # A name for each batch, against the rows in them.
    parts = [f"{path}/batch={r['batch']}" for r in known.orderBy("batch").collect()]
    return spark.read.option("basePath", path).parquet(*parts).drop("batch")


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; False if there is none."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def _log(spark: SparkSession, path: str, version: int, note: str) -> None:
    entry = spark.range(0, 1, 1, 1).select(F.lit(version).cast("bigint").alias("version"), F.lit(note).alias("note"))
    entry.write.mode("append").json(f"{path}/log")
