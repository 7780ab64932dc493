"""Hard negatives by angular triangle filtering.

Components become integers, floor(scale * x); a score is an integer inner product. Every
row keeps its norm and its angles to some reference directions. By the triangle inequality
on the sphere, an anchor at angle f to a direction and rows at angles from t to u lie
between ``max(0, f - u, t - f)`` and ``min(pi, f + u)`` apart. That gives a cosine
interval for each direction, and times the norms a score interval, widened for rounding.
Rows are sorted by label, nearest direction and angle; windows of such rows whose interval
meets no score that is still wanted are passed over, the others get integer scores.

First come each anchor's positives, from chunks of windows of its label, then for each
positive the highest scores of other labels within ``least`` to ``most`` percent of its
score. Anchors meet chunks in groups; a task holds one group and one chunk.

The reference directions are fitted on at most ``sample`` rows of a vector length (those
of the smallest hash), by spherical k-means. They steer what is passed over, not results.

Defined results: rows with a null label, vector, component or vec_id, or a component that
is not finite, take no part; rows are partners only of rows with as many components; rows
that repeat a vec_id are rows of their own, and an anchor that is repeated gives its rows
repeatedly; empty vectors score 0; scores beyond 64 bits saturate; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ofertario.llm.common import only
from ofertario.session import written

ROWS = "vec_id long, label long, length int, vector array<double>, norm double, angles array<double>, home int"
EXACT, SAFE = 2.0**53, 1e-6


def directions(vectors: np.ndarray, count: int, turns: int = 8) -> np.ndarray:
    """Unit vectors in the middle of clusters of ``vectors``, by spherical k-means."""
    size = np.linalg.norm(vectors, axis=1)
    unit = vectors[size > 0] / size[size > 0, None]
    if not len(unit):
        return np.zeros((0, vectors.shape[1]))
    centres = unit[np.random.default_rng(1).permutation(len(unit))[:count]]
    for _ in range(turns):
        home = (unit @ centres.T).argmax(axis=1)
        sums = np.array([unit[home == i].sum(axis=0) for i in range(len(centres))])
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], centres)
    return centres


def _floored(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -np.finfo(float).max, np.finfo(float).max)


def _placed(scale: float, by_length: dict[int, np.ndarray]):
    """Integer components, norm and angles to the reference directions of each row."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, norms, angles, homes = [], [], [], []
            for vector in batch.column("vector"):
                own = _floored(np.array(vector.values.to_numpy(zero_copy_only=False), float), scale)
                big = np.abs(own).max(initial=0.0)
                small = own / big if big else own
                size = float(np.linalg.norm(small))
                centres = by_length.get(len(own), np.zeros((0, len(own))))
                cosines = centres @ small / size if size else np.zeros(len(centres))
                vectors.append(own)
                norms.append(min(size * big, np.finfo(float).max))
                angles.append(np.arccos(np.clip(cosines, -1.0, 1.0)))
                homes.append(int(angles[-1].argmin()) if len(centres) else 0)
            columns = [
                batch.column("vec_id"),
                batch.column("label"),
                pa.array([len(v) for v in vectors], pa.int32()),
                pa.array(vectors, pa.list_(pa.float64())),
                pa.array(norms, pa.float64()),
                pa.array(angles, pa.list_(pa.float64())),
                pa.array(homes, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "length", "vector", "norm", "angles", "home"])

    return placed


def rows_of(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float).reshape(len(column), -1)


def scores(a: np.ndarray, b: np.ndarray, largest: float) -> np.ndarray:
    """Exact integer inner products; Python's integers where doubles would round."""
    if largest < EXACT:
        return a @ b.T
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    return np.array([[sum(x * y for x, y in zip(r, s, strict=True)) for s in whole[1]] for r in whole[0]], object)


class Windows:
    """Windows of a chunk's rows, with what bounds their scores."""

    def __init__(self, rows: pd.DataFrame, width: int):
        self.rows = rows.sort_values("row")
        self.width = width

    def __iter__(self):
        for start in range(0, len(self.rows), self.width):
            own = self.rows.iloc[start : start + self.width].sort_values(["vec_id", "row"])
            yield own, rows_of(own["angles"]), own["norm"].to_numpy()


def interval(norms: np.ndarray, angles: np.ndarray, row_angles: np.ndarray, row_norms: np.ndarray):
    """(low, high): bounds of each anchor's scores with the rows of a window."""
    near, far = np.zeros(len(norms)), np.full(len(norms), np.pi)
    if row_angles.shape[1] and row_norms.min() > 0:
        least, most = row_angles.min(axis=0), row_angles.max(axis=0)
        near = np.maximum(np.maximum(angles - most, least - angles).max(axis=1), 0.0)
        far = np.minimum((angles + most).min(axis=1), np.pi)
    near, far = np.maximum(near - SAFE, 0.0), np.minimum(far + SAFE, np.pi)
    low, high = np.cos(far), np.cos(near)
    small, large = norms * row_norms.min(), norms * row_norms.max()
    low, high = low * np.where(low < 0, large, small), high * np.where(high > 0, large, small)
    room = 1.0 + SAFE * large
    return low - room, high + room


def _best(found: list[pd.DataFrame], keys: list[str], k: int, columns: list[str]) -> pd.DataFrame:
    """The k best rows of each key: highest score, then smallest vec_id."""
    if not found:
        return pd.DataFrame({c: [] for c in columns}, dtype="int64")
    both = pd.concat(found).sort_values([*keys, "score", "vec_id"], ascending=[True] * len(keys) + [False, True])
    both = both.groupby(keys).head(k)
    both["score"] = [max(-(2**63), min(2**63 - 1, int(s))) for s in both["score"]]
    return both[columns].astype("int64")


def _hits(s: np.ndarray, wanted: np.ndarray, best: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where wanted scores reach the k-th best so far; ``best`` takes them in."""
    hit = wanted & (s >= best[:, :1])
    own = np.where(hit, s, -np.inf)
    best[:] = np.sort(np.concatenate([best, own], axis=1), axis=1)[:, -k:]
    return np.nonzero(hit)


def _positives(k: int, width: int):
    columns = ["anchor", "vec_id", "score"]

    def positives(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return _best([], ["anchor"], k, columns)
        vectors, angles, norms = rows_of(anchors["vector"]), rows_of(anchors["angles"]), anchors["norm"].to_numpy()
        labels, names = anchors["label"].to_numpy(), anchors["row"].to_numpy()
        best, found = np.full((len(anchors), k), -np.inf, object if norms.max() > 1e7 else float), []
        for own, row_angles, row_norms in Windows(rows, width):
            _, high = interval(norms, angles, row_angles, row_norms)
            may = np.flatnonzero((high >= best[:, 0].astype(float)) & np.isin(labels, own["label"]))
            if not len(may):
                continue
            s = scores(vectors[may], rows_of(own["vector"]), norms[may].max() * row_norms.max())
            wanted = (own["label"].to_numpy() == labels[may, None]) & (own["row"].to_numpy() != names[may, None])
            top = best[may]
            at, of = _hits(s, wanted, top, k)
            best[may] = top
            found.append(pd.DataFrame({"anchor": names[may][at], "vec_id": own["vec_id"].to_numpy()[of], "score": s[at, of]}))
        return _best(found, ["anchor"], k, columns)

    return positives


def _negatives(k: int, width: int, least: int, most: int):
    columns = ["anchor", "place", "vec_id", "score"]

    def negatives(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(rows):
            return _best([], ["anchor", "place"], k, columns)
        vectors, angles, norms = rows_of(anchors["vector"]), rows_of(anchors["angles"]), anchors["norm"].to_numpy()
        labels, names = anchors["label"].to_numpy(), anchors["row"].to_numpy()
        kind = object if norms.max() > 1e7 else float
        slots = max(map(len, anchors["limits"]))
        lows, highs = (np.full((len(anchors), slots), x, kind) for x in (np.inf, -np.inf))
        for i, limits in enumerate(anchors["limits"]):
            for j, score in enumerate(limits):
                lows[i, j], highs[i, j] = -(-least * int(score) // 100), most * int(score) // 100
        best, found = np.full((len(anchors), slots, k), -np.inf, kind), []
        for own, row_angles, row_norms in Windows(rows, width):
            low, high = interval(norms, angles, row_angles, row_norms)
            floor = np.maximum(lows, best[:, :, 0]).astype(float)
            overlap = (high[:, None] >= floor) & (low[:, None] <= highs.astype(float)) & (lows <= highs)
            may = np.flatnonzero(overlap.any(axis=1))
            if not len(may):
                continue
            s = scores(vectors[may], rows_of(own["vector"]), norms[may].max() * row_norms.max())
            other = own["label"].to_numpy() != labels[may, None]
            for j in range(slots):
                top = best[may, j]
                at, of = _hits(s, other & (s >= lows[may, j, None]) & (s <= highs[may, j, None]), top, k)
                best[may, j] = top
                ids = own["vec_id"].to_numpy()[of]
                found.append(pd.DataFrame({"anchor": names[may][at], "place": j, "vec_id": ids, "score": s[at, of]}))
        return _best(found, ["anchor", "place"], k, columns)

    return negatives


def mine(
    vectors: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    least: int = 50,
    most: int = 95,
    scale: float = 256.0,
    references: int = 16,
    sample: int = 4096,
    window: int = 256,
    chunk: int = 8192,
    group: int = 2048,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the
    ids in ``anchors`` (anchor_id)."""
    spark = vectors.sparkSession
    cols = only(vectors, vec_id=id_col, label=label_col, vector=vector_col)
    cols = cols.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    cols = cols.where("vec_id IS NOT NULL AND label IS NOT NULL").where(F.coalesce(F.forall("vector", finite), F.lit(False)))
    drawn = cols.select("vector", F.xxhash64("vec_id", "vector").alias("h")).orderBy("h").limit(sample).collect()
    lengths = {len(r["vector"]) for r in drawn} - {0}
    by_length = {
        n: directions(_floored(np.array([r["vector"] for r in drawn if len(r["vector"]) == n], float), scale), references)
        for n in lengths
    }
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    turn = F.coalesce(F.try_element_at("angles", F.col("home") + 1), F.lit(0.0))
    order = ["length", "label", "home", "turn", "vec_id"]
    placed = cols.mapInArrow(_placed(scale, by_length), ROWS).withColumn("turn", turn)
    placed = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("turn")
    placed = placed.withColumn("row", F.monotonically_increasing_id())
    placed = written(placed.withColumn("chunk", F.floor(F.col("row") / chunk).cast("long")), "vectors")
    asked = anchors.select(F.col("anchor_id").cast("long").alias("vec_id")).distinct()
    asked = placed.drop("chunk").join(asked, "vec_id", "left_semi")
    groups = max(1, -(-asked.count() // group))
    asked = written(asked.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups))), "anchors")
    spread = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    rows = placed.select("row", "vec_id", "label", "vector", "norm", "angles", "length", "chunk", spread.alias("group"))
    chunks = written(placed.groupBy("length", "label", "chunk").count().drop("count"), "chunks")
    meet = ["length", "chunk", "group"]
    met = rows.groupBy(*meet)

    own = asked.join(chunks, ["length", "label"]).groupBy(*meet)
    found = own.cogroup(met).applyInPandas(_positives(positives, window), "anchor long, vec_id long, score long")
    order = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec_id")
    found = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < positives)
    found = written(found, "positives")
    limits = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("limits"))
    limits = limits.select(F.col("anchor").alias("row"), F.col("limits.score").alias("limits"))
    waiting = asked.join(limits, "row").join(chunks.select("length", "chunk").distinct(), "length").groupBy(*meet)
    schema = "anchor long, place int, vec_id long, score long"
    worse = waiting.cogroup(met).applyInPandas(_negatives(negatives, window, least, most), schema)
    order = Window.partitionBy("anchor", "place").orderBy(F.col("score").desc(), "vec_id")
    worse = worse.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    worse = worse.select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = found.select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = asked.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        worse.join(named, ["anchor", "place"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
