"""MinHash near-duplicates: banded candidates, pruned by sequential Bayesian verification.

1. A text's set of shingles becomes ``bands * rows`` minimum hashes; equal sets are one
class. Two classes with an equal band are candidates. 32 bands of 5 rows miss a pair of
similarity 0.8 with probability 3e-6, nearer ones less. 2. Candidates are compared batch
by batch of their signatures. After ``n`` hashes with ``m`` matches and an even prior the
similarity is Beta(m+1, n-m+1); a pair goes as soon as the posterior probability that it
reaches the limit falls below ``miss``. 3. Survivors are confirmed on their full sets.

Only components are asked for. So in every bucket first one head, then another, meets the
members of other components; a bucket whose members are in one component is done, and so
is a head. What is then left of the buckets is gathered by the largest component that each
holds, and compared in blocks: members outside that component with all members. Pairs are
pruned and confirmed inside a block and only links leave it, so a large bucket is neither
one task nor a list of all its pairs, and no link between candidates is lost.

Defined results: null and empty texts have no shingles and link with nothing; texts of
fewer words than a shingle are one shingle; rows that repeat a doc_id, with any texts, are
rows of their own; rows without doc_id have a size but no component, link nothing and are
kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ofertario.llm.common import only
from ofertario.llm.components import components
from ofertario.llm.jaccard import mixed, shingles
from ofertario.session import written

POINTS = "doc_id long, size long, class long, keys array<long>, signature binary"
SEED, STEP = 20_240_601, 2048
#: Sides of the blocks that a large bucket is compared in.
OUTSIDE, MEMBERS = 256, 1024


def minima(found: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    least = np.full(len(factors), np.uint64(2**64 - 1))
    for at in range(0, len(found), STEP):
        least = np.minimum(least, (found[at : at + STEP, None] * factors + terms).min(axis=0))
    return least


def least_matches(total: int, batch: int, percent: int, miss: float) -> dict[int, int]:
    """After so many hashes, the fewest matches that do not yet rule out a link.

    The posterior P(similarity >= t | m of n) is P(Binomial(n + 1, t) <= m).
    """
    t, found = percent / 100, {}
    for n in [*range(batch, total, batch), total]:
        below, m = 0.0, -1
        while below < miss:
            m += 1
            below += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        found[n] = m
    return found


def likely(a: np.ndarray, b: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Which rows of two signature matrices stay likely through all batches."""
    left, matches, start = np.arange(len(a)), np.zeros(len(a), np.int64), 0
    for n, fewest in least.items():
        matches = matches + (a[left, start:n] == b[left, start:n]).sum(axis=1)
        keep = matches >= fewest
        left, matches, start = left[keep], matches[keep], n
    return left


def _signed(n: int, bands: int, rows: int):
    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(SEED)
        factors = draw.integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
        terms = draw.integers(0, 2**64, bands * rows, np.uint64, endpoint=False)
        number = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            size, names, keys, signatures = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, n)
                size.append(len(found))
                names.append(int(mixed(found + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                if not len(found):
                    keys.append([])
                    signatures.append(b"")
                    continue
                least = mixed(minima(found, factors, terms))
                least >>= np.uint64(48)
                key = number.copy()
                for column in least.reshape(bands, rows).T:
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
                keys.append(key.view(np.int64))
                signatures.append(least.astype(np.uint16).tobytes())
            columns = [
                batch.column("doc_id"),
                pa.array(size, pa.int64()),
                pa.array(names, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(signatures, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "class", "keys", "signature"])

    return signed


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, n) for t in batch.column("text").to_pylist()]
            names = [int(mixed(x + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) for x in found]
            columns = [pa.array(names, pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["class", "found"])

    return sets


def matrix(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint16).reshape(len(blobs), -1)


def _likely_pairs(least: dict[int, int]):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                a, b = (matrix(batch.column(c).to_pylist()) for c in ("sig_a", "sig_b"))
                yield batch.select(["a", "b"]).take(pa.array(likely(a, b, least)))

    return pairs


def _confirmed(percent: int):
    def confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return confirmed


def linked(own: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of ``sets`` are as similar to ``own`` as a link asks."""
    sizes = np.array([len(x) for x in sets])
    theirs = np.concatenate(sets)
    place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
    common = np.add.reduceat((own[place] == theirs).astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= percent * (len(own) + sizes - common)


def _across(least: dict[int, int], percent: int, rows: int):
    def across(outside: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        """Links of a block of outside members with a block of members: one to each component."""
        found: list[tuple[int, int]] = []
        if len(outside) and len(members):
            theirs = matrix(members["signature"].tolist())
            sets = [np.frombuffer(x, np.uint64) for x in members["found"]]
            ids, labels = members["class"].to_numpy(), members["label"].to_numpy()
        for name, label, signature, blob in outside[["class", "label", "signature", "found"]].itertuples(index=False):
            if not len(members):
                break
            near = np.flatnonzero(labels != label)
            mine = np.broadcast_to(np.frombuffer(signature, np.uint16), (len(near), theirs.shape[1]))
            near = near[likely(mine, theirs[near], least)]
            equal = (theirs[near] == mine[0]) if len(near) else np.zeros((0, rows), bool)
            near = near[equal.reshape(len(near), -1, rows).all(axis=2).any(axis=1)] if len(near) else near
            if len(near):
                near = near[linked(np.frombuffer(blob, np.uint64), [sets[i] for i in near], percent)]
            _, first = np.unique(labels[near], return_index=True)
            found += [(int(name), int(ids[i])) for i in near[first]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return across


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return members.withColumn("label", F.col("class"))
    named = labels.select(F.col("id").alias("class"), F.col("component").alias("label"))
    return members.join(named, "class", "left").withColumn("label", F.coalesce("label", "class"))


def _left_in_blocks(now: DataFrame, signatures: DataFrame, sets: DataFrame, across) -> DataFrame:
    """Links between different components in what is left of the buckets."""
    sizes = now.groupBy("key", "label").agg(F.count("*").alias("rows"))
    largest = F.max(F.struct("rows", "label"))["label"].alias("main")
    open_ = sizes.groupBy("key").agg(largest, F.count("*").alias("labels")).where("labels > 1").select("key", "main")
    rows = written(now.join(open_, "key").select("main", "class", "label").distinct(), "open-members")
    blocks = rows.groupBy("main").agg(
        F.ceil(F.count_if(F.col("label") != F.col("main")) / OUTSIDE).cast("long").alias("outs"),
        F.ceil(F.count("*") / MEMBERS).cast("long").alias("ins"),
    )
    rows = written(rows.join(blocks, "main").join(signatures, "class").join(sets, "class"), "open-sets")
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    spread = lambda n: F.pmod(F.xxhash64("class"), F.col(n))
    columns = ["main", "class", "label", "signature", "found"]
    outside = rows.where("label <> main").select(*columns, spread("outs").alias("out"), each("ins").alias("in"))
    members = rows.select(*columns, each("outs").alias("out"), spread("ins").alias("in"))
    meet = ["main", "out", "in"]
    return outside.groupBy(*meet).cogroup(members.groupBy(*meet)).applyInPandas(across, "a long, b long")


def link(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    bands: int = 32,
    rows: int = 5,
    batch: int = 32,
    miss: float = 1e-6,
    heads: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach), kept."""
    cols = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    points = written(cols.mapInArrow(_signed(words, bands, rows), POINTS), "points")
    classes = points.where("size > 0 AND doc_id IS NOT NULL").groupBy("class")
    classes = classes.agg(F.min("doc_id").alias("id"), F.first("keys").alias("keys"), F.first("signature").alias("signature"))
    classes = written(classes, "classes")
    keyed = classes.select("class", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1").select("key")
    members = written(keyed.join(shared, "key"), "members")
    signatures = classes.select("class", "signature")
    wanted = classes.select("class", "id").join(members.select("class").distinct(), "class", "left_semi")
    texts = cols.join(wanted.select("id").distinct().hint("shuffle_hash"), F.col("doc_id") == F.col("id"))
    sets = texts.select("text").mapInArrow(_sets(words), "class long, found binary").dropDuplicates(["class"])
    sets = written(sets, "sets")
    least = least_matches(bands * rows, batch, percent, miss)

    def both(pairs: DataFrame, table: DataFrame, column: str, name: str) -> DataFrame:
        for side in ("a", "b"):
            own = table.select(F.col("class").alias(side), F.col(column).alias(f"{name}_{side}"))
            pairs = pairs.join(own, side)
        return pairs

    def confirmed(pairs: DataFrame) -> DataFrame:
        return written(both(pairs, sets, "found", "set").mapInArrow(_confirmed(percent), "a long, b long"), "links")

    links, labels = None, None
    for turn in range(heads):
        now = written(_labelled(members, labels), "labelled")
        first = F.min(F.struct(F.xxhash64(F.lit(turn), "class").alias("h"), "class", "label")).alias("first")
        head = now.groupBy("key").agg(first, F.min("label").alias("low"), F.max("label").alias("high"))
        head = head.where("low <> high").select("key", F.col("first.class").alias("head"), F.col("first.label").alias("of"))
        met = written(now.join(head, "key").where("class <> head"), "met")
        a, b = F.least("class", "head").alias("a"), F.greatest("class", "head").alias("b")
        pairs = both(met.where("label <> of").select(a, b).distinct(), signatures, "signature", "sig")
        new = confirmed(written(pairs.mapInArrow(_likely_pairs(least), "a long, b long"), "likely"))
        links = new if links is None else links.unionByName(new)
        labels = components(links)
        members = met.select("class", "key")
    across = _across(least, percent, rows)
    left = written(_left_in_blocks(_labelled(members, labels), signatures, sets, across), "links")
    labels = components(links.unionByName(left))
    named = _labelled(classes.select("class", "id"), labels)
    smallest = named.groupBy("label").agg(F.min("id").alias("component_id"))
    named = written(named.join(smallest, "label").select("class", "component_id"), "components")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return points.join(named, "class", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
