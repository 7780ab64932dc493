"""From the landing zone to the fact table, batch by batch, through keyed state.

Spark's state store keeps the newest record of every offer id; in update mode a batch
hands on only the ids it has records of. Of these, the ones that changed are applied:

* ``ids``      offer id -> the content hash and record it has now
* ``members``  the newest records by content hash, a content's records dealt over
  ``SALTS`` parts by id, so that one content held by most offers is no single bucket
* ``fact``     the row of the record each content hash is published by

An id that changed leaves its old content and joins its new one; these two contents, and
no others, choose their published record anew. All three are bucketed folders, of which a
batch rewrites those it touches. ``ids`` is written last: a batch that is run again finds
either all of its changes applied, and does nothing, or applies them again.

Records of one id, day and payload number are told apart by their payload's hash, as in
the batch load. The state holds one record per offer id for good; it has no time limit, as
an offer can change after any time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.category import resolve_category
from ..operators.conform import keep_worth_showing
from ..operators.dedup import latest_by, with_content_hash, with_discount_id
from ..operators.merge import FACT_COLUMNS
from ..plans.build import staged, without_payload
from ..session import scratch, written
from ..sources.keyed import read_keyed, replace_buckets, touched_buckets, upsert_keyed
from ..sources.landing import usable
from ..sources.seeds import read_seed
from ..sources.tables import remove

HASH, SALTS = "discount_content_hash", 8


def newest_records(stream: DataFrame, tie_path: str | None = None) -> DataFrame:
    """discount_id and its newest record; for update mode."""
    rows = with_discount_id(without_payload(keep_worth_showing(staged(usable(stream))), tie_path))
    order = F.struct("last_updated_at_date", "record_order")
    record = F.struct(*[c for c in rows.columns if c != "discount_id"])
    return rows.groupBy("discount_id").agg(F.max_by(record, order).alias("record"))


def _member(content: str, offer: str = "discount_id"):
    return F.concat_ws("/", F.col(content), F.pmod(F.xxhash64(offer), F.lit(SALTS)).cast("string"))


def _fact_of(members: DataFrame, overrides: DataFrame, categories: DataFrame) -> DataFrame:
    """The published row of every content hash among ``members``."""
    winners = latest_by(members, [HASH], [F.desc("last_updated_at_date"), F.asc("discount_id")])
    offers = resolve_category(winners.drop("record_order"), overrides, categories)
    return offers.select(HASH, *[F.col(c).alias(name) for name, c in FACT_COLUMNS.items()])


def apply_changes(
    batch: DataFrame, path: str, overrides: DataFrame | None = None, categories: DataFrame | None = None, buckets: int = 64
) -> int:
    """Takes a batch of (discount_id, record) into the tables; how many ids changed."""
    folders: list[str] = []
    with scratch(folders):
        changed = _apply(batch, path, overrides, categories, buckets)
    for folder in folders:
        remove(batch.sparkSession, folder)
    return changed


def _apply(batch, path, overrides, categories, buckets) -> int:
    spark = batch.sparkSession
    overrides = read_seed(spark, "merchant_overrides") if overrides is None else overrides
    categories = read_seed(spark, "merchant_categories") if categories is None else categories
    new = written(with_content_hash(batch.select("discount_id", "record.*")), "newest")
    known = new.select("discount_id", HASH, F.struct("last_updated_at_date", "record_order").alias("version"))
    old = read_keyed(spark, f"{path}/ids", known.schema, buckets, touched_buckets(new, "discount_id", buckets))
    old = old.select("discount_id", F.col(HASH).alias("old_hash"), F.col("version").alias("old_version"))
    moved = known.join(old, "discount_id", "left")
    moved = moved.where(~F.col("version").eqNullSafe(F.col("old_version")) | ~F.col(HASH).eqNullSafe(F.col("old_hash")))
    moved = written(moved.select("discount_id", HASH, "version", "old_hash"), "moved")
    count = moved.count()
    if not count:
        return 0
    rows = new.join(moved.select("discount_id"), "discount_id", "left_semi").withColumn("member", _member(HASH))
    left = moved.where("old_hash IS NOT NULL")
    places = rows.select("member").unionByName(left.select(_member("old_hash").alias("member")))
    touched = touched_buckets(places, "member", buckets)
    members = read_keyed(spark, f"{path}/members", rows.schema, buckets, touched)
    members = members.join(moved.select("discount_id"), "discount_id", "left_anti").unionByName(rows)
    replace_buckets(members, f"{path}/members", "member", buckets, touched, spread="discount_id")
    hashes = moved.select(HASH).unionByName(left.select(F.col("old_hash").alias(HASH))).distinct()
    hashes = written(hashes, "contents")
    parts = hashes.select(F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), HASH)
    parts = parts.select(F.concat_ws("/", HASH, F.col("salt").cast("string")).alias("member"))
    members = read_keyed(spark, f"{path}/members", rows.schema, buckets, touched_buckets(parts, "member", buckets))
    fresh = _fact_of(members.drop("member").join(hashes, HASH, "left_semi"), overrides, categories)
    touched = touched_buckets(hashes, HASH, buckets)
    kept = read_keyed(spark, f"{path}/fact", fresh.schema, buckets, touched).join(hashes, HASH, "left_anti")
    replace_buckets(kept.unionByName(fresh), f"{path}/fact", HASH, buckets, touched)
    upsert_keyed(moved.select("discount_id", HASH, "version"), f"{path}/ids", "discount_id", buckets)
    return count


def start_fact_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    tie_path: str | None = None,
    overrides: DataFrame | None = None,
    categories: DataFrame | None = None,
    buckets: int = 64,
) -> StreamingQuery:
    """Takes in all files present, then stops; one query per path at a time."""

    def take_in(batch: DataFrame, _: int) -> None:
        apply_changes(batch, path, overrides, categories, buckets)

    return (
        newest_records(stream, tie_path)
        .writeStream.outputMode("update")
        .foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/fact").select(*FACT_COLUMNS)
