"""Uniqueness over increments, by a persistent index of key digests.

The index holds a digest of every value that a checked column has had, bucketed and sorted
by digest. An increment is reduced to its own digests, in one shuffle for all columns,
and these are merged with the index: the index is neither shuffled nor sorted, and the
checked table is not read. New digests are appended.

Each digest names the increment that brought it. An increment that is checked again meets
its own digests and neither fails by them nor appends them twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import written
from .quality import Check, key_digest, tally_report

_SCHEMA = "digest BINARY, name STRING, increment STRING"


class KeyIndex:
    """Digests at ``path``; ``table`` is the name it has in this session's catalog."""

    def __init__(self, spark: SparkSession, path: str, table: str, buckets: int = 64):
        self.spark, self.table, self.buckets, self.path = spark, table, buckets, path
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def append(self, digests: DataFrame) -> None:
        """Rows dealt by bucket first, so that each bucket gets one file an increment."""
        (
            digests.select("digest", "name", "increment")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.table)
        )


def check_increment(rows: DataFrame, columns: list[str], index: KeyIndex, increment: str) -> DataFrame:
    """The report of ``unique`` on the columns, over the increment and all before it.

    Fails once per value of the increment that occurs again, in it or before; NULLs are
    not compared. The values are known to later increments afterwards.
    """
    entries = [F.struct(F.lit(c).alias("name"), key_digest(c).alias("digest")) for c in columns]
    own = rows.select(F.inline(F.array(*entries))).filter("digest IS NOT NULL")
    own = own.groupBy("digest", "name").agg(F.count(F.lit(1)).alias("n"))
    old = index.read().withColumnRenamed("increment", "_of")
    old = old.groupBy("digest", "name").agg(
        F.count_if(F.col("_of") != increment).alias("before"), F.count_if(F.col("_of") == increment).alias("again")
    )
    met = written(own.join(old, ["digest", "name"], "left"), "digests")
    sums = []
    for i, column in enumerate(columns):
        mine = F.col("name") == column
        fails = mine & ((F.col("n") > 1) | (F.col("before") > 0))
        sums += [F.count_if(fails).alias(f"f{i}"), F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n{i}")]
    # Rows of the check are those of its column, so each has a total of its own.
    checks = [Check("unique", c, None, where=F.lit(True)) for c in columns]
    report = written(tally_report(met.agg(*sums), checks), "report")
    new = met.filter("before IS NULL").select("digest", "name", F.lit(increment).alias("increment"))
    index.append(new)
    return report
