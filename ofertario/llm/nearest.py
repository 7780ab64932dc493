"""Approximate nearest neighbours by shifted space-filling curves, then completed.

Vectors are projected at random to a few dimensions, shifted, and put on a Hilbert
curve, several times with other projections and shifts. Each ordering is range-
partitioned and cut into blocks of ``block`` rows; a query meets the rows of its own
block and of the two next to it, all finds are merged and reranked by the inner
product of the original vectors.

In many dimensions neighbours are hardly nearer than other vectors, and windows of a
fixed size miss some. The last step looks, for each query, at every block of the first
ordering that its centre and radius do not rule out against the worst neighbour found
so far; so the result is exact. ``complete=False`` leaves that step out.

Scores are inner products in double precision, summed alike for every pair; ties go
to the smaller id. Defined results: vectors that are null, empty or zero or hold null
or non-finite components take no part; vectors of other lengths are never compared;
rows that repeat an id are one vector (the largest by components); an empty table or
no query gives no rows; with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ofertario.llm.common import only
from ofertario.session import written

PAIRS = "query_id long, vec_id long, score double"


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of rows of ``bits``-bit coordinates (Skilling's transform)."""
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    level = np.uint64(1 << (bits - 1))
    one = np.uint64(1)
    while level > one:
        below = level - one
        for i in range(n):
            high = (x[i] & level) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & below).astype(np.uint64)
            x[0] = np.where(high, x[0] ^ below, x[0] ^ swap)
            x[i] ^= swap
        level >>= one
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint64)
    level = np.uint64(1 << (bits - 1))
    while level > one:
        turn ^= np.where((x[n - 1] & level) != 0, level - one, 0).astype(np.uint64)
        level >>= one
    x ^= turn
    key = np.zeros(x.shape[1], np.uint64)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(bit)) & one)
    return key


def _keys(orders: int, dims: int, bits: int):
    """A row for each vector and ordering, with its place on the curve."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = pd.Series(batch.column("vector").to_pylist())
            for length, rows in vectors.groupby(vectors.map(len)):
                matrix = np.array(rows.tolist(), float)
                unit = matrix / np.abs(matrix).max(axis=1, keepdims=True)
                unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
                at = pa.array(rows.index.to_numpy())
                for order in range(orders):
                    draw = np.random.default_rng((length, order))
                    flat = unit @ draw.standard_normal((length, dims))
                    # Nearly all of a standard normal lies in six units; the shift moves the grid.
                    grid = (flat + 4 + draw.random(dims)) / 9 * 2**bits
                    key = hilbert(np.clip(grid, 0, 2**bits - 1), bits)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("vec_id").take(at),
                            batch.column("vector").take(at),
                            pa.array(np.full(len(rows), length, np.int32)),
                            pa.array(np.full(len(rows), order, np.int32)),
                            pa.array((key >> np.uint64(1)).astype(np.int64)),
                        ],
                        ["vec_id", "vector", "length", "ordering", "curve"],
                    )

    return keys


def exact_scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, each summed in the same order."""
    return np.add.reduce(queries * rows, axis=1)


def best_in_block(k: int):
    def best(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """The k best rows of one block for each query that looks at it, if they reach
        the worst neighbour that it has already (``worst``)."""
        if queries.empty or rows.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        q = np.array(queries["vector"].tolist(), float)
        r = np.array(rows["vector"].tolist(), float)
        ids, asked = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        near = q @ r.T
        near[asked[:, None] == ids[None, :]] = -np.inf
        few = min(k, len(ids))
        edge = -np.partition(-near, few - 1, axis=1)[:, few - 1]
        if "worst" in queries:
            edge = np.maximum(edge, queries["worst"].to_numpy(float))
        slack = np.where(np.isfinite(edge), 1e-9 * (1 + np.abs(edge)), 0.0)
        at, of = np.nonzero(np.isfinite(near) & (near >= (edge - slack)[:, None]))
        found = pd.DataFrame({"query_id": asked[at], "vec_id": ids[of], "score": exact_scores(q[at], r[of])})
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return found.groupby("query_id").head(k)

    return best


def complete_chunk(k: int):
    def complete(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        """Rows of a chunk of blocks that reach a query's worst neighbour so far."""
        found = [best_in_block(k)(queries[:0], rows[:0])]
        q = np.array(queries["vector"].tolist(), float)
        size = np.sqrt((q * q).sum(axis=1)) if len(q) else np.zeros(0)
        worst = queries["worst"].to_numpy(float)
        for _, block in rows.groupby("block"):
            if not len(q):
                break
            r = np.array(block["vector"].tolist(), float)
            centre = r.mean(axis=0)
            radius = np.sqrt(((r - centre) ** 2).sum(axis=1).max())
            reach = q @ centre + size * radius
            may = reach >= worst - 1e-9 * (1 + np.abs(reach))
            if may.any():
                found.append(best_in_block(k)(queries[may], block))
        best = pd.concat(found).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return best.groupby("query_id").head(k)

    return complete


def neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    orders: int = 8,
    dims: int = 8,
    bits: int = 7,
    block: int = 512,
    complete: bool = True,
    query_group: int = 4096,
    blocks_in_chunk: int = 32,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank from 1, vec_id, score, for the ids in ``queries`` (query_id)."""
    spark = vectors.sparkSession
    cols = only(vectors, vec_id=id_col, vector=vector_col)
    cols = cols.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vector").cast("array<double>").alias("vector"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = F.forall("vector", finite) & F.exists("vector", lambda x: x != 0.0)
    cols = cols.where(F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False)))
    cols = cols.groupBy("vec_id").agg(F.max("vector").alias("vector"))
    schema = "vec_id long, vector array<double>, length int, ordering int, curve long"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        cols.mapInArrow(_keys(orders, dims, bits), schema)
        .repartitionByRange(parts, "length", "ordering", "curve", "vec_id")
        .sortWithinPartitions("length", "ordering", "curve", "vec_id")
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id() % F.lit(1 << 33))
    )
    ordered = written(ordered, "curves")
    # Where each partition's rows of an ordering start: one number per partition and ordering.
    starts = ordered.groupBy("length", "ordering", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    before = Window.partitionBy("length", "ordering").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first"))
    placed = ordered.join(F.broadcast(starts.drop("rows", "first")), ["length", "ordering", "part"])
    placed = placed.select(
        "length", "ordering", F.floor((F.col("start") + F.col("at")) / block).cast("long").alias("block"), "vec_id", "vector"
    )
    placed = written(placed, "blocks")
    asked = queries.select(F.col("query_id").cast("long").alias("query_id")).distinct()
    where = ["length", "ordering", "block"]
    own = placed.join(asked, F.col("vec_id") == F.col("query_id")).select("query_id", "vector", *where)
    own = written(own, "asked")
    near = own.withColumn("block", F.explode(F.array(*[F.col("block") + d for d in (-1, 0, 1)])))
    found = near.groupBy(*where).cogroup(placed.groupBy(*where)).applyInPandas(best_in_block(k), PAIRS)
    found = written(found, "window-finds")

    def ranked(pairs: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
        best = pairs.distinct().withColumn("rank", F.row_number().over(order))
        return best.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    if not complete:
        return ranked(found)
    top = written(ranked(found), "window-best")
    worst = top.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("found"))
    # Blocked: each group of queries meets each chunk of blocks once.
    first = placed.where("ordering = 0").drop("ordering")
    chunk = F.floor(F.col("block") / blocks_in_chunk).cast("long")
    chunks = first.groupBy("length").agg((F.max(chunk) + 1).alias("chunks"))
    groups = max(1, -(-asked.count() // query_group))
    waiting = (
        own.where("ordering = 0")
        .join(worst, "query_id", "left")
        .join(F.broadcast(chunks), "length")  # a row for each vector length
        .select(
            "query_id",
            "vector",
            "length",
            F.when(F.col("found") >= k, F.col("worst")).otherwise(float("-inf")).alias("worst"),
            F.pmod(F.xxhash64("query_id"), F.lit(groups)).alias("group"),
            F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
        )
    )
    rows = first.select("*", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    meet = ["length", "chunk", "group"]
    rows = rows.withColumn("group", F.col("group").cast("long"))
    seen = waiting.groupBy(*meet).cogroup(rows.groupBy(*meet)).applyInPandas(complete_chunk(k), PAIRS)
    return ranked(top.select("query_id", "vec_id", "score").unionByName(seen))
