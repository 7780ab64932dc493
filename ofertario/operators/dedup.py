"""Keeping the winner of each key, and ranking all rows of a key.

``latest_by`` keeps one row per key. Spark limits every key to one row within
each map task before the shuffle, so a key with a third of all rows sends one
row per task, not its rows.

``rank_within`` numbers every row of a key. There nothing can be thrown away,
so the key is split by ordered parts: each part is numbered in its own task
and starts after the rows counted in the parts before it. ``rank_by_samples``
needs no parts: it sorts by samples of the order itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import content_hash, surrogate_key
from ..session import written


def latest_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which should be a total order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).filter("_place = 1").drop("_place")


def rank_within(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    parts: list[tuple[Column, bool]],
    name: str = "rn",
) -> DataFrame:
    """``row_number`` per key for groups of any size.

    ``parts`` are (expression, descending) pairs that cut a key into pieces
    whose order agrees with ``order``: sorting by the parts first and by
    ``order`` within a part must give the same sequence. The part sizes of one
    key are added up in one task, so cut by something whose number does not
    grow with the rows, such as days, hours or the first digits of a hash.
    """
    cuts = [f"_part{i}" for i in range(len(parts))]
    # Structs compare equal where their fields are NULL alike, so a NULL key is
    # a group like any other.
    cell = F.struct(
        F.struct(*keys).alias("group"),
        *[expr.alias(c) for c, (expr, _) in zip(cuts, parts)],
    )
    cut = df.withColumn("_cell", cell)
    by_part = [
        F.desc(f"_cell.{c}") if down else F.asc(f"_cell.{c}")
        for c, (_, down) in zip(cuts, parts)
    ]
    before = (
        Window.partitionBy("_cell.group")
        .orderBy(*by_part)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        cut.groupBy("_cell")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_cell", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy("_cell").orderBy(*order)
    ranked = cut.withColumn("_inside", F.row_number().over(inside))
    return ranked.join(starts, "_cell").select(
        *df.columns, (F.col("_inside") + F.col("_start")).cast("bigint").alias(name)
    )


def rank_by_samples(df: DataFrame, keys: list[str], order: list[Column], name: str = "rn") -> DataFrame:
    """``row_number`` per key for groups of any size and any order.

    A sample sort: Spark samples keys and order, cuts the whole range at the samples'
    quantiles and sorts each piece, so a hot key is cut wherever its rows are dense. The
    rows of one key in earlier pieces are then counted; only one number per key and piece
    meets in a task. Rows that are equal in all of ``order`` are cut, too.

    Pieces depend on the samples, so the sorted rows are written before they are counted.
    """
    group = F.struct(*keys)
    placed = df.withColumn("_group", group).withColumn("_tie", F.monotonically_increasing_id())
    by = [F.asc("_group"), *order, F.asc("_tie")]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_tie")
    placed = placed.withColumn("_part", F.spark_partition_id())
    placed = written(placed.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_group", "_part").agg(F.count(F.lit(1)).alias("_size"), F.min("_at").alias("_first"))
    start = F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first") + 1
    starts = starts.select("_group", "_part", start.alias("_start"))
    return placed.join(starts, ["_group", "_part"]).select(
        *[f"`{c}`" for c in df.columns], (F.col("_start") + F.col("_at")).alias(name)
    )


def with_record_order(df: DataFrame, tie_path: str | None = None) -> DataFrame:
    """Adds ``record_order``, which settles records of one id and day.

    It is the number at ``tie_path`` of the payload, if one is named, then a
    hash of the payload. With it the payload, by far the widest column, need
    not be read or shuffled to find the newest record.
    """
    tie = F.lit(None).cast("bigint")
    if tie_path:
        tie = F.try_variant_get("discount_metadata", tie_path, "bigint")
    fingerprint = F.xxhash64(F.to_json("discount_metadata"))
    order = F.struct(tie.alias("tie"), fingerprint.alias("fingerprint"))
    return df.withColumn("record_order", order)


def newest_first() -> list[Column]:
    return [F.desc("last_updated_at_date"), F.desc("record_order"), F.asc("merchant_category_name")]


def with_discount_id(df: DataFrame) -> DataFrame:
    return df.select(surrogate_key("source_id", "issuer_name").alias("discount_id"), "*")


def dedup_by_source(df: DataFrame, tie_path: str | None = None) -> DataFrame:
    """The newest record of every source id."""
    if "record_order" not in df.columns:
        df = with_record_order(df, tie_path)
    return latest_by(with_discount_id(df), ["discount_id"], newest_first())


def with_content_hash(df: DataFrame) -> DataFrame:
    return df.select(content_hash().alias("discount_content_hash"), "*")


def dedup_audit(df: DataFrame) -> DataFrame:
    """Every record with its place ``rn`` among those of equal content.

    Reads ``df`` twice, so give it a written frame rather than a long plan. Ids are MD5 texts, so their first three digits cut the records of one
    content and day into 4,096 even parts.
    """
    return rank_within(
        with_content_hash(df),
        ["discount_content_hash"],
        [F.desc("last_updated_at_date"), F.asc("discount_id")],
        [(F.col("last_updated_at_date"), True), (F.substring("discount_id", 1, 3), False)],
    )


def dedup_by_content(df: DataFrame) -> DataFrame:
    """The record the audit ranks first, without ranking the others."""
    return latest_by(
        with_content_hash(df),
        ["discount_content_hash"],
        [F.desc("last_updated_at_date"), F.asc("discount_id")],
    )
