"""Exact dedup by a persistent digest index.

The index is a table bucketed and sorted by digest. A batch is reduced to one
row per digest, the digests that the index lacks are found by a sort-merge anti
join and appended, and every row is told which document stays.

Defined results: a null text counts as empty; an empty batch appends nothing and
reports nothing; of equal texts in a batch the largest doc_id stays (rows without
doc_id last); of rows that repeat doc_id and text one stays; a text the index
knows from an earlier batch stays with the document recorded there, and the whole
batch group is dropped. Other columns pass through ``kept_rows`` untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ofertario.llm.common import only
from ofertario.session import fresh_folder, written


def normalised(text: Column) -> Column:
    """The text that is compared: as it stands, null as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


class DigestIndex:
    """(digest, keep_id) rows at ``path``, in ``buckets`` buckets sorted by digest.

    The files outlive the session: a new one opens them again by path and the
    same number of buckets. Choose buckets so that one holds what a task sorts.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.buckets = spark, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT) USING parquet"
            f" CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS"
            f" LOCATION '{path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, new: DataFrame) -> None:
        """``new`` must not hold digests that the index has."""
        (
            new.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .saveAsTable(self.name)
        )


def dedup(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, digest, known.

    Appends the batch's new digests to ``index``. ``known`` tells that an earlier
    batch had the text. Texts are read once; what follows moves digests only.
    """
    digests = written(
        only(docs, doc_id=id_col, text=text_col).select(
            "doc_id",
            F.monotonically_increasing_id().alias("row"),
            F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        ),
        "digests",
    )
    groups = written(
        digests.groupBy("digest").agg(
            F.max(F.struct("doc_id", "row")).alias("top"), F.count("*").alias("group_size")
        ),
        "digest-groups",
    )
    known_rows = index.read().hint("merge")
    fresh = written(
        groups.join(known_rows, "digest", "left_anti").select(
            "digest",
            "group_size",
            F.lit(False).alias("known"),
            F.col("top.doc_id").cast("long").alias("keep_id"),
            F.col("top.row").alias("keep_row"),
        ),
        "new-digests",
    )
    known = written(
        groups.join(known_rows, "digest").select(
            "digest",
            "group_size",
            F.lit(True).alias("known"),
            "keep_id",
            F.lit(None).cast("long").alias("keep_row"),
        ),
        "known-digests",
    )
    index.append(fresh)
    told = fresh.unionByName(known)
    # A digest that holds more than 1/1024 of the rows is one of at most 1024:
    # those are broadcast, so no hot group meets in one task.
    total = digests.count()
    hot = told.where(F.col("group_size") * 1024 > F.lit(total))
    cold = told.where(F.col("group_size") * 1024 <= F.lit(total))
    in_hot = digests.join(F.broadcast(hot), "digest")
    in_cold = digests.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest")
    return in_hot.unionByName(in_cold).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False)).alias("kept"),
        "digest",
        "known",
    )


def kept_rows(
    docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows leave by an anti join on doc_id and digest, whose pairs are unique but
    for repeated rows; of these, if there are any, one is picked.
    """
    verdict = written(dedup(docs, index, id_col, text_col), "verdicts")
    per_pair = verdict.groupBy("doc_id", "digest").agg(
        F.max("kept").alias("stays"), F.count("*").alias("rows")
    )
    settled = written(
        per_pair.where(~F.col("stays") | (F.col("rows") > 1)).select(
            F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), "stays"
        ),
        "settled",
    )
    tagged = docs.withColumn("__text_digest", F.unhex(F.sha2(normalised(docs[f"`{text_col}`"]), 256)))
    same = tagged[f"`{id_col}`"].eqNullSafe(settled["__id"]) & (
        tagged["__text_digest"] == settled["__digest"]
    )
    out = tagged.join(settled, same, "left_anti").drop("__text_digest")
    repeated = settled.where("stays")
    if repeated.isEmpty():
        return out
    same = tagged[f"`{id_col}`"].eqNullSafe(repeated["__id"]) & (
        tagged["__text_digest"] == repeated["__digest"]
    )
    again = Window.partitionBy(f"`{id_col}`", "__text_digest").orderBy(F.lit(0))
    one = (
        tagged.join(repeated, same, "left_semi")
        .withColumn("__nth", F.row_number().over(again))
        .where("__nth = 1")
        .drop("__nth", "__text_digest")
    )
    return out.unionByName(one)


def new_index(spark: SparkSession, buckets: int | None = None) -> DigestIndex:
    """An empty index in the shared folder, with as many buckets as shuffle partitions."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, fresh_folder(spark, "digest-index"), buckets)
