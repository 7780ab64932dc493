"""N-gram Jaccard join as a join in a metric space, exact up to 64-bit shingle hashes.

One minus the Jaccard similarity is a metric; two documents link within ``reach``.
Only their components are asked for, so links inside a component found so far need no
further look.

1. Equal sets are one point. 2. Random document pivots do not part a corpus: nearly all
documents are at distance 1 from nearly all others, and every window would take in every
document. The outermost regions are therefore found by fragments. The hash range is cut
into more classes than two linked sets can differ in, so at least one class is equal in
both; documents with an equal fragment are in one region, and regions that share
documents are one group. Classes depend on a band of sizes; documents near a band's
upper end are replicated into the next band. 3. In each group pivots are drawn, and
distances of all documents to them taken; documents within reach of a pivot are linked.
Each document belongs to the Voronoi region of its nearest pivot and is replicated to
the region of any pivot that is at most twice the reach farther: by the triangle
inequality no link is lost. Regions recurse until they no longer shrink; there the
documents outside the largest component are compared, by their rarest shingles, with
those whose distances to all pivots lie within reach of theirs. 4. In groups too large
for a task, documents of which too few shingles occur in any other document there can link
with nothing and leave; the others are grouped anew by the fragments they share. Groups
that are too large then, too, are cut into blocks; blocks of documents outside the
largest component meet every block once.

Defined results: null and empty texts have no shingles and link with nothing; texts of
fewer words than a shingle are one shingle; rows that repeat a doc_id, with any texts, are
rows of their own; rows without doc_id get no component and link nothing; an empty table
gives no rows. Components go to their fixed point, in rounds that halve paths; after 60
rounds, more than any table of long paths can need, an error stops them.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ofertario.llm.common import kept_last, map_texts, only, release
from ofertario.llm.components import components
from ofertario.session import written

#: Growth of the size bands, and shingles of a group that one task takes.
BAND, TASK_SHINGLES = 1.5, 1 << 22
PIVOTS, LEAF = 8, 256
EDGES = "a long, b long"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted hashes of the distinct shingles of ``n`` words of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(n, len(words))
    total = np.full(len(words) - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + hashes[i : len(words) - size + 1 + i])
    return np.unique(total)


class Fragments:
    """Fragment keys of a set: linked sets that differ have one in common."""

    def __init__(self, percent: int, spare: int = 0):
        if percent < 70:
            raise ValueError("bands are made for similarities of at least 70 percent")
        self.percent, self.spare = percent, spare
        self.tops = [0, 1]

    def spares(self, band: int) -> int:
        """How many fragments more than one linked sets of a band have in common at least."""
        return min(self.spare, (self.tops[band - 1] + 1) // 4)

    def differ(self, top: int) -> int:
        """The most that two linked sets of at most ``top`` shingles can differ in."""
        return 2 * top * (100 - self.percent) // (100 + self.percent)

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * BAND)))
        return int(np.searchsorted(self.tops, size))

    def classes(self, band: int) -> tuple[int, int]:
        """How many classes, and how many of them may be empty without being told."""
        self.band(self.tops[-1] + 1) if band >= len(self.tops) else None
        top, least = self.tops[band], self.tops[band - 1] + 1
        differ, empty = self.differ(top), 0
        if not differ:
            return 0, 0
        for _ in range(20):
            count = differ + 1 + empty + self.spares(band)
            expected = count * math.exp(-least / count)
            empty = math.ceil(expected + 4 * math.sqrt(expected)) + 1
        return differ + 1 + empty + self.spares(band), empty

    def of(self, found: np.ndarray) -> list[tuple[list[int], int]]:
        """(keys, spares) in the set's own band and, near its upper end, in the next."""
        band, out = self.band(len(found)), []
        bands = [band]
        if 100 * len(found) >= self.percent * (self.tops[band] + 1):
            bands.append(band + 1)
        spread = mixed(found)
        for b in bands:
            count, may_be_empty = self.classes(b)
            if not count:
                out.append(([], 0))
                continue
            # Hashes are sorted, so the members of a class follow each other.
            of = (((found >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)
            starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
            sums, present = np.add.reduceat(spread, starts), of[starts]
            if count - len(present) > may_be_empty:
                none = np.setdiff1d(np.arange(count), present)
                sums, present = np.r_[sums, np.zeros(len(none), np.uint64)], np.r_[present, none]
            keys = mixed(mixed(sums) + present.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(b))
            out.append((keys.view(np.int64).tolist(), self.spares(b)))
        return out


POINTS = "doc_id long, digest long, size long, one long, two long"
KEYED = "one long, fragment long, later boolean, spare int"


def _names(found: np.ndarray) -> list[int]:
    """Two sums of a set's hashes; equal sets have equal ones."""
    return [int(mixed(found + np.uint64(k)).sum(dtype=np.uint64).view(np.int64)) for k in (1, 2)]


def _points(n: int):
    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, n) for text in batch.column("text").to_pylist()]
            sums = [_names(found) for found in sets]
            columns = [[len(found) for found in sets], [x[0] for x in sums], [x[1] for x in sums]]
            arrays = [batch.column("doc_id"), batch.column("digest"), *[pa.array(c, pa.int64()) for c in columns]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "digest", "size", "one", "two"])

    return points


def _keyed(n: int, percent: int, spare: int):
    """A row for each fragment of a set; a set that a task has met is not cut again."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fragments, met = Fragments(percent, spare), set()
        for batch in batches:
            one, keys, later, spares = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingles(text, n)
                name = _names(found)[0]
                if not len(found) or name in met:
                    continue
                met.add(name)
                for place, (own, spared) in enumerate(fragments.of(found)):
                    one.append(np.full(len(own), name, np.int64))
                    keys.append(np.array(own, np.int64))
                    later.append(np.full(len(own), place > 0))
                    spares.append(np.full(len(own), spared, np.int32))
            if one:
                columns = [pa.array(np.concatenate(c)) for c in (one, keys, later, spares)]
                yield pa.RecordBatch.from_arrays(columns, ["one", "fragment", "later", "spare"])

    return keyed


def _sets(n: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t, n) for t in batch.column("text").to_pylist()]
            names = pa.array([_names(x)[0] for x in found], pa.int64())
            columns = [names, batch.column("gid"), pa.array([x.tobytes() for x in found], pa.binary())]
            same = pa.compute.equal(names, batch.column("one"))
            yield pa.RecordBatch.from_arrays(columns, ["id", "gid", "found"]).filter(same)

    return sets


class Region:
    """Documents of a group: ids, shingles one after the other, sizes, components."""

    def __init__(self, ids, blobs, percent: int):
        self.ids, self.percent = ids, percent
        parts = [np.frombuffer(b, np.uint64) for b in blobs]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.parent = list(range(len(ids)))
        self.edges: list[tuple[int, int]] = []
        self.reach = 1 - percent / 100

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = i = self.parent[self.parent[i]]
        return i

    def link(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.edges.append((int(self.ids[i]), int(self.ids[j])))

    def set_of(self, i: int) -> np.ndarray:
        return self.flat[self.starts[i] : self.starts[i] + self.sizes[i]]

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of one set with others."""
        own, sizes = self.set_of(i), self.sizes[others]
        if not len(others):
            return sizes
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[others] - ends + sizes, sizes) + np.arange(ends[-1])
        theirs = self.flat[at]
        place = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
        return np.add.reduceat((own[place] == theirs).astype(np.int64), ends - sizes)

    def linked(self, i: int, others: np.ndarray, common: np.ndarray) -> np.ndarray:
        union = self.sizes[i] + self.sizes[others] - common
        return 100 * common >= self.percent * union

    def largest(self, rows: np.ndarray) -> np.ndarray:
        """Whether each of ``rows`` is in their largest component."""
        roots = np.array([self.root(i) for i in rows])
        names, counts = np.unique(roots, return_counts=True)
        return roots == names[np.argmax(counts)]

    def join(self, rows: np.ndarray) -> None:
        """Links that make the components among ``rows`` right."""
        distances: list[np.ndarray] = []
        pivots: list[int] = []
        while len(pivots) < PIVOTS:
            outside = rows[~self.largest(rows)] if pivots else rows
            left = [i for i in outside if i not in pivots] if pivots else [rows[len(rows) // 2]]
            if not left:
                return
            pivot = left[len(left) // 2]
            common = self.common(pivot, rows)
            for j in rows[self.linked(pivot, rows, common)]:
                self.link(pivot, j)
            pivots.append(pivot)
            distances.append(1 - common / (self.sizes[pivot] + self.sizes[rows] - common))
        matrix = np.array(distances)
        home = matrix.argmin(axis=0)
        if len(rows) > LEAF:
            near = matrix[home, np.arange(len(rows))]
            inside = matrix <= near + 2 * self.reach + 1e-9
            if inside.sum(axis=1).max() <= 0.7 * len(rows):
                for region in inside:
                    if region.sum() > 1:
                        self.join(rows[region])
                return
        self.leaf(rows, matrix)

    def leaf(self, rows: np.ndarray, matrix: np.ndarray) -> None:
        outside = np.flatnonzero(~self.largest(rows))
        sizes = self.sizes[rows]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[rows] - ends + sizes, sizes) + np.arange(ends[-1])
        _, token, times = np.unique(self.flat[at], return_inverse=True, return_counts=True)
        by_token: dict[int, list[int]] = defaultdict(list)
        rarest = []
        for k, end in enumerate(ends):
            own = token[end - sizes[k] : end]
            # Linked sets share one of so many of their rarest shingles.
            few = sizes[k] - -(-self.percent * sizes[k] // 100) + 1
            own = own[np.lexsort((own, times[own]))][:few].tolist()
            rarest.append(own)
            for t in own:
                by_token[t].append(k)
        for k in outside:
            own = self.root(rows[k])
            others = {j for t in rarest[k] for j in by_token[t] if j != k}
            others = np.array([j for j in sorted(others) if self.root(rows[j]) != own], np.int64)
            if not len(others):
                continue
            fits = 100 * np.minimum(sizes[others], sizes[k]) >= self.percent * np.maximum(sizes[others], sizes[k])
            fits &= (np.abs(matrix[:, others] - matrix[:, [k]]) <= self.reach + 1e-9).all(axis=0)
            others = rows[others[fits]]
            for j in others[self.linked(rows[k], others, self.common(rows[k], others))]:
                self.link(rows[k], j)


def _join_group(percent: int):
    def join(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        region = Region(group["id"].to_numpy(), group["found"].tolist(), percent)
        if len(group) > 1:
            region.join(np.arange(len(group)))
        return pd.DataFrame(region.edges, columns=["a", "b"]).astype("int64")

    return join


def _join_blocks(percent: int):
    def join(outside: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        both = pd.concat([outside, block]).drop_duplicates("id")
        return _join_group(percent)(both) if len(outside) and len(block) else _join_group(percent)(both[:0])

    return join


PIECES = "range long, id long, several boolean, shared long, piece binary"


def _pieces(ranges: int, chunk: int):
    """Sets cut by hash range, a chunk of them at a time.

    What several sets of a chunk hold is counted at once and goes on once, for no set, so
    that a shingle of all documents makes one entry a chunk.
    """

    def cut(ids: list, found: list[np.ndarray]) -> pa.RecordBatch:
        sizes = [len(x) for x in found]
        flat, owner = np.concatenate(found), np.repeat(np.arange(len(found)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        starts = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        times = np.diff(np.r_[starts, len(flat)])
        many = np.repeat(times > 1, times)
        shared = np.bincount(owner[many], minlength=len(found))
        # One entry for each shingle: its only owner, or no one's.
        flat, owner = flat[starts], np.where(times > 1, -1, owner[starts])
        of = (((flat >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)
        order = np.lexsort((owner, of))
        flat, owner, of = flat[order], owner[order], of[order]
        starts = np.flatnonzero(np.r_[True, (of[1:] != of[:-1]) | (owner[1:] != owner[:-1])])
        ends = np.r_[starts[1:], len(flat)]
        columns = [
            [*of[starts].tolist(), *[i % ranges for i in ids]],
            [*[0 if o < 0 else ids[o] for o in owner[starts]], *ids],
            [*(owner[starts] < 0).tolist(), *[False] * len(ids)],
            [*[0] * len(starts), *shared.tolist()],
            [*[flat[a:b].tobytes() for a, b in zip(starts, ends, strict=True)], *[b""] * len(ids)],
        ]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["range", "id", "several", "shared", "piece"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, held = [], [], 0
        for batch in batches:
            for name, blob in zip(batch.column("id").to_pylist(), batch.column("found").to_pylist(), strict=True):
                ids.append(name)
                found.append(np.frombuffer(blob, np.uint64))
                held += len(found[-1])
                if held >= chunk:
                    yield cut(ids, found)
                    ids, found, held = [], [], 0
        if ids:
            yield cut(ids, found)

    return pieces


def _count_shared(pieces: pd.DataFrame) -> pd.DataFrame:
    """How many shingles of a range each set shares with others."""
    parts = [np.frombuffer(b, np.uint64) for b in pieces["piece"]]
    sizes = np.array([len(p) for p in parts], np.int64)
    flat = np.concatenate(parts)
    _, shingle = np.unique(flat, return_inverse=True)
    # An entry for no set stands for two of them at least.
    weight = np.repeat(np.where(pieces["several"], 2, 1), sizes)
    many = np.bincount(shingle, weights=weight)[shingle] > 1 if len(flat) else np.zeros(0, bool)
    shared = np.bincount(np.repeat(np.arange(len(parts)), sizes), weights=many, minlength=len(parts))
    out = pd.DataFrame({"id": pieces["id"], "shared": pieces["shared"] + shared.astype(np.int64)})
    return out[~pieces["several"]]


def _regrouped(
    sets: DataFrame, hot: DataFrame, keys: DataFrame, sized: DataFrame, percent: int, task_shingles: int
) -> tuple[DataFrame, DataFrame]:
    """(id, size, gid): the documents of groups too large for a task that may link at all, in
    groups of their own; and (one, fragment), their fragments that two of them share.

    Linked sets hold ``percent`` of their shingles in common, so a set of which fewer occur
    in another set links with nothing, and chains no others.
    """
    inside = sets.join(hot.select("gid"), "gid", "left_semi").select("id", "found")
    total = hot.agg(F.sum("blocks")).first()[0]
    pieces = inside.mapInArrow(_pieces(total, task_shingles // 2), PIECES)
    counted = pieces.groupBy("range").applyInPandas(_count_shared, "id long, shared long")
    counted = written(counted, "shared-counts").groupBy("id").agg(F.sum("shared").alias("shared"))
    left = sized.select("id", "size").join(counted, "id").where(F.col("shared") * 100 >= F.col("size") * percent)
    left = written(left.select("id", "size"), "sharing")
    own = written(keys.join(left.select(F.col("id").alias("one")), "one", "left_semi"), "sharing-keys")
    heads = own.groupBy("fragment").agg(F.min("one").alias("head"), F.count("*").alias("docs"))
    own = written(own.join(heads.where("docs > 1").drop("docs"), "fragment"), "sharing-heads")
    edges = own.where("one <> head").select(F.col("one").alias("a"), F.col("head").alias("b")).distinct()
    groups = components(written(edges, "sharing-edges")).withColumnRenamed("component", "gid")
    return written(left.join(groups, "id"), "regrouped"), own.select("one", "fragment")


def _too_large(sized: DataFrame, task_shingles: int) -> DataFrame:
    """(gid, blocks) of the groups (id, size, gid) that are too large for a task."""
    totals = sized.groupBy("gid").agg(F.sum("size").alias("total")).where(F.col("total") > task_shingles)
    return written(totals.select("gid", F.ceil(F.col("total") * 2 / task_shingles).cast("long").alias("blocks")), "hot-groups")


def _hot_links(sets: DataFrame, hot: DataFrame, keys: DataFrame, percent: int) -> DataFrame:
    """Links of groups that are too large for a task.

    ``keys`` (one, fragment) tells which documents may link: a block of documents outside
    the largest component gets, of another block, those that share a fragment with some of
    them, and only blocks that do meet.
    """
    # Sizes of groups that hold TASK_SHINGLES shingles and more: few against documents.
    sets = sets.join(hot.select("gid", "blocks"), "gid")
    sets = sets.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks"))).drop("blocks")
    # One pivot for each group: the document of the smallest hash meets every block.
    first = sets.groupBy("gid").agg(F.min(F.struct(F.xxhash64("id").alias("h"), "id")).alias("p"))
    pivots = sets.join(first.select("gid", F.col("p.id").alias("id")), ["gid", "id"]).select("gid", "id", "found")
    spread = pivots.join(hot.select("gid", "blocks"), "gid").select(
        "gid", "id", "found", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    )
    near = ["gid", "block"]
    spread = written(spread, "hot-pivots")
    inner = spread.groupBy(*near).cogroup(sets.groupBy(*near)).applyInPandas(_join_blocks(percent), EDGES)
    inner = written(inner, "hot-inner")
    found = components(inner).withColumnRenamed("component", "part")
    labelled = sets.select("gid", "id", "block").join(found, "id", "left").withColumn("part", F.coalesce("part", "id"))
    labelled = written(labelled, "hot-parts")
    most = labelled.groupBy("gid", "part").count().groupBy("gid")
    most = most.agg(F.max(F.struct("count", "part"))["part"].alias("largest"))
    outside = labelled.join(most, "gid").where("part <> largest").select("gid", "id", F.col("block").alias("outer"))
    outside = written(outside, "hot-outside")
    keyed = keys.withColumnRenamed("one", "id")
    asking = written(keyed.join(outside, "id"), "hot-asking")
    asked = written(keyed.join(labelled.select("gid", "id", "block"), "id"), "hot-asked")
    meet = ["gid", "block", "outer"]
    blocks = asked.select("gid", "fragment", "block").distinct()
    outer = asking.join(blocks, ["gid", "fragment"]).select("id", *meet).distinct()
    outers = asking.select("gid", "fragment", "outer").distinct()
    member = asked.join(outers, ["gid", "fragment"]).select("id", *meet).distinct()
    texts = lambda: sets.select(F.col("id").alias("id"), F.col("found").alias("found"))
    sides = (written(outer, "hot-outer"), written(member, "hot-members"))
    one, other = (side.join(texts(), "id").select(*meet, "id", "found").groupBy(*meet) for side in sides)
    across = one.cogroup(other).applyInPandas(_join_blocks(percent), EDGES)
    return inner.unionByName(across)


def _shared(
    cols: DataFrame, classes: DataFrame, words: int, percent: int, spare: int
) -> tuple[DataFrame, DataFrame]:
    """(a, b): each set and the smallest set that it has a telling fragment in common with;
    and (one, fragment), the telling fragments.

    Fragments are dealt out once; where they lie together they are counted, and only
    fragments of two sets or more go on.
    """
    parts = int(cols.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = map_texts(cols.select("text"), _keyed(words, percent, spare), KEYED).repartition(4 * parts, "fragment")
    # Sets that several tasks have met; and sets without a document of an id.
    keyed = keyed.dropDuplicates(["fragment", "one"])
    together = Window.partitionBy("fragment")
    many = keyed.withColumn("docs", F.count("*").over(together)).withColumn("head", F.min("one").over(together))
    many = written(many.where("docs > 1"), "fragments").join(classes.select(F.col("id").alias("one")), "one", "left_semi")
    if spare:
        most = Window.partitionBy("one", "later").orderBy(F.col("docs").desc(), "fragment")
        many = many.withColumn("place", F.row_number().over(most)).where("place > spare").select("one", "fragment")
        many = written(many, "rarer")
        heads = many.groupBy("fragment").agg(F.min("one").alias("head"), F.count("*").alias("docs"))
        many = many.join(heads.where("docs > 1").select("fragment", "head"), "fragment")
    many = written(many.select("one", "fragment", "head"), "shared")
    maybe = many.where("one <> head").select(F.col("one").alias("a"), F.col("head").alias("b"))
    return written(maybe.distinct(), "maybe"), many.select("one", "fragment")


def _linked(cols: DataFrame, words: int, percent: int, task_shingles: int, spare: int) -> DataFrame:
    """``cols`` (doc_id, text) as doc_id, digest, n_shingles, component_id, stays: whether the
    row's set and id are those that its component is named by."""
    cols = cols.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("digest", F.xxhash64("text"))
    points = written(map_texts(cols, _points(words), POINTS), "points")
    classes = points.where("size > 0").groupBy(F.col("one").alias("id"), "two", "size").agg(F.min("doc_id").alias("doc"))
    classes = written(classes.where("doc IS NOT NULL"), "classes")
    maybe, keys = _shared(cols, classes, words, percent, spare)
    release(cols.sparkSession)
    # Each set keeps the edge to its smallest head, which its other heads then have too.
    heads = maybe.withColumn("least", F.min("b").over(Window.partitionBy("a")))
    to_least = heads.select("a", F.col("least").alias("b"))
    between = heads.where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    stars = to_least.unionByName(between).distinct()
    groups = written(components(stars).withColumnRenamed("component", "gid"), "groups")
    sized = classes.select("id", "size", "doc").join(groups, "id")
    hot = _too_large(sized, task_shingles)
    # Texts are long: neither side is broadcast at one size and shuffled at another, nor
    # are texts sorted.
    wanted = sized.select(F.col("doc").alias("doc_id"), F.col("id").alias("one"), "gid").hint("shuffle_hash")
    texts = cols.select("doc_id", "text").join(wanted, "doc_id")
    sets = map_texts(texts.select("one", "gid", "text"), _sets(words), "id long, gid long, found binary")
    sets = written(sets, "sets")
    in_groups = lambda few: few.groupBy("gid").applyInPandas(_join_group(percent), EDGES)
    links = written(in_groups(sets.join(hot, "gid", "left_anti")), "links")
    if not hot.isEmpty():
        regrouped, keys = _regrouped(sets, hot, keys, sized, percent, task_shingles)
        release(cols.sparkSession)
        hot = _too_large(regrouped, task_shingles)
        sets = sets.drop("gid").join(regrouped.select("id", "gid"), "id")
        links = links.unionByName(written(in_groups(sets.join(hot, "gid", "left_anti")), "regrouped-links"))
        if not hot.isEmpty():
            links = links.unionByName(_hot_links(sets, hot, keys, percent))
    found = components(links).withColumnRenamed("id", "__id")
    named = classes.select("id", "doc").join(found, F.col("id") == F.col("__id"), "left")
    named = named.select("id", "doc", F.coalesce("component", "id").alias("component"))
    first = named.groupBy("component").agg(F.min(F.struct("doc", "id")).alias("first"))
    named = named.join(first, "component").select(
        F.col("id").alias("one"),
        F.col("first.doc").alias("component_id"),
        F.when(F.col("first.id") == F.col("id"), F.col("doc")).alias("named_by"),
    )
    has_id = F.col("doc_id").isNotNull()
    return points.join(written(named, "components"), "one", "left").select(
        "doc_id",
        "digest",
        F.col("size").alias("n_shingles"),
        F.when(has_id, F.coalesce("component_id", "doc_id")).alias("component_id"),
        (~has_id | (F.col("size") == 0) | F.coalesce(F.col("named_by") == F.col("doc_id"), F.lit(False))).alias("stays"),
    )


def link(
    docs: DataFrame,
    words: int = 3,
    percent: int = 90,
    task_shingles: int = TASK_SHINGLES,
    spare: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id that links reach).

    With ``spare`` there are so many classes more that linked sets have ``spare`` + 1 equal
    fragments; each document then leaves out its ``spare`` most frequent ones. All
    documents rank fragments alike, so the rarest that two have in common stays in both.
    That keeps widespread passages from chaining documents of little similarity, which
    matters where fragments are small, as at low similarities.
    """
    cols = only(docs, doc_id=id_col, text=text_col)
    with kept_last() as last:
        return last(_linked(cols, words, percent, task_shingles, spare).select("doc_id", "n_shingles", "component_id"))


def one_of_each(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    task_shingles: int = TASK_SHINGLES,
    spare: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, whole, of which each component keeps one: that of its smallest
    doc_id. Rows go by id and text together, so another text of a copy's id stays. Rows
    without doc_id, and texts without words, all stay; of rows that repeat both the id and
    the text that stays, one does.
    """
    cols = only(docs, doc_id=id_col, text=text_col)
    key = [docs[f"`{id_col}`"].cast("long").alias("__id"), F.xxhash64(docs[f"`{text_col}`"]).alias("__text")]
    with kept_last() as last:
        linked = written(_linked(cols, words, percent, task_shingles, spare), "linked")
        # The same id and text in several rows: they stay or go together, and then one stays.
        pairs = linked.where("doc_id IS NOT NULL AND n_shingles > 0")
        pairs = pairs.groupBy(F.col("doc_id").alias("__id"), F.col("digest").alias("__text"))
        pairs = pairs.agg(F.first("stays").alias("stays"), F.count("*").alias("rows"))
        odd = last(pairs.where("NOT stays OR rows > 1"))
    keyed = docs.select("*", *key)
    single = keyed.join(odd, ["__id", "__text"], "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])
    again = odd.where("stays")
    if again.isEmpty():
        return single
    doubled = keyed.join(again, ["__id", "__text"], "left_semi").dropDuplicates(["__id", "__text"])
    return single.unionByName(doubled.drop("__id", "__text"))
