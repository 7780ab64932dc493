"""Sharding by vector bin packing.

Every group of equal texts is a vector: its bytes, words and rows as shares of
their totals. Items are placed from the largest down, each into the shard where
the dot product of its vector with the residual capacity is highest.

So that the number of items does not grow with the table, groups below 1/4096 of
every total are first gathered by hash into 4096 bundles; at most 3 * 4096 groups
are larger. A group above 1/8 of a shard's share of some total is cut by row hash
into pieces below that size, as no shard could balance it whole; equal texts stay
together otherwise. The law that holds is ``bytes``: sizes near equal.

Defined results: a null text has no bytes, so size 1; rows that repeat a doc_id
are rows of their own; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ofertario.llm.common import buckets_for, hash_bucket, only, sum_before
from ofertario.session import written

BUNDLES = 4096


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(b) + 1 for b in raw], pa.int64()),
                pa.array([len(b.split()) for b in raw], pa.int64()),
                pa.array([zlib.crc32(b) for b in raw], pa.int64()),
                pa.array([xxhash.xxh3_64_intdigest(b) - 2**63 for b in raw], pa.int64()),
            ],
            ["doc_id", "size", "words", "text_crc32", "text_hash"],
        )


def place(items: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each item (rows: shares of the totals, largest first)."""
    residual = np.full((shards, items.shape[1]), 1.0 / shards)
    chosen = np.empty(len(items), dtype=int)
    for i, item in enumerate(items):
        chosen[i] = shard = int(np.argmax(residual @ item))
        residual[shard] -= item
    return chosen


def shard(
    docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, words, text_crc32, shard and slot, gapless from 0 in each shard."""
    spark = docs.sparkSession
    cols = only(docs, doc_id=id_col, text=text_col)
    kind = cols.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, size long, words long, text_crc32 long, text_hash long"
    rows = written(cols.mapInArrow(_measures, schema), "measures")
    totals = rows.agg(F.count("*"), F.sum("size"), F.sum("words")).first()
    n, size, words = (max(1, x or 0) for x in totals)
    share = F.greatest(F.col("rows") / n, F.col("size") / size, F.col("words") / words)
    groups = written(
        rows.groupBy("text_hash")
        .agg(F.count("*").alias("rows"), F.sum("size").alias("size"), F.sum("words").alias("words"))
        .withColumn("share", share)
        .withColumn("pieces", F.ceil(F.least(F.col("share") * shards * 8, F.col("rows"))).cast("int")),
        "groups",
    )
    large = groups.where(F.col("share") * BUNDLES > 1)
    # At most 3 * BUNDLES rows: no more groups can hold that share of a total.
    of_large = F.broadcast(large.select("text_hash", "pieces"))
    keyed = rows.join(of_large, "text_hash", "left").select(
        *rows.columns,
        F.col("pieces").isNotNull().alias("own"),
        F.when(F.col("pieces").isNull(), F.pmod("text_hash", F.lit(BUNDLES))).otherwise(F.col("text_hash")).alias("item"),
        F.when(F.col("pieces") > 1, F.pmod(F.xxhash64("doc_id"), F.col("pieces"))).otherwise(0).alias("piece"),
    )
    keyed = written(keyed, "items")
    items = (
        keyed.groupBy("own", "item", "piece")
        .agg(F.sum("size").alias("size"), F.sum("words").alias("words"), F.count("*").alias("rows"))
        .toPandas()
    )
    vectors = items[["size", "words", "rows"]].to_numpy(float) / [size, words, n]
    order = np.lexsort((items["piece"], items["item"], items["own"], -vectors.max(axis=1, initial=0)))
    items = items.iloc[order]
    items["shard"] = place(vectors[order], shards)
    placed = spark.createDataFrame(
        [(bool(o), int(i), int(p), int(s)) for o, i, p, s in items[["own", "item", "piece", "shard"]].values.tolist()],
        "own boolean, item long, piece long, shard int",
    )
    parts = buckets_for(n)
    put = keyed.join(F.broadcast(placed), ["own", "item", "piece"]).select(
        "doc_id",
        "size",
        "words",
        "text_crc32",
        "shard",
        F.lit(1).alias("one"),
        hash_bucket(F.xxhash64("doc_id", "text_hash"), parts).alias("part"),
    )
    put = written(put, "placed")
    slots = sum_before(put, ["shard"], "part", ["doc_id", "text_crc32"], "one", "slot")
    return slots.select("doc_id", "size", "words", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
