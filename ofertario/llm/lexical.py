"""Ranked lexical search by the Best Position Algorithm over impact lists.

A document's score for an item is the sum of its terms' impacts. Every task of the search
holds segments of documents: for each term a list of documents, highest impact first, and
for each document its terms with their places in those lists. An item is answered by
reading its lists from their best positions on: every document met is looked up in all
lists at once, which marks its places there as seen. A list's best position is the end of
its unbroken run of seen places. A document not met yet has no more than the sum of the
impacts just behind the best positions; reading stops when that sum is strictly below the
k-th score, so ties are all met. The k-th score is carried from segment to segment.

Lengths, document frequencies and totals are counted by Spark over all documents before.
Items are answered in blocks of about ``block_terms`` terms, which is what is broadcast and
what frequencies come to the driver for; an item of more terms is a block of its own.

Defined results: null and empty texts have no terms; documents without terms are not
counted; rows that repeat a doc_id are documents of their own; documents without doc_id
rank behind others of equal score; items without terms give no rows; rows that repeat an
item_id (null too) are one item with the terms of all; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ofertario.llm.common import only
from ofertario.session import written

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: Postings of a segment, places read at once at first, tasks merged at once.
SEGMENT, FIRST, MERGED = 1 << 21, 32, 64
FOUND = "item int, doc_id long, score long, part int"


def terms(text: str | None) -> list[str]:
    return TERM.findall((text or "").translate(LOWER))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(terms(t))) for t in batch.column("text").to_pylist()]
        columns = [batch.column("item_id"), pa.array(found, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["item_id", "terms"])


def _counted(numbers):
    """Each document's length, and the numbers and counts of the terms asked for."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = numbers.value
        for batch in batches:
            sizes, found, times = [], [], []
            for text in batch.column("text").to_pylist():
                own = terms(text)
                sizes.append(len(own))
                counts = Counter(filter(known.__contains__, own))
                found.append([known[t] for t in counts])
                times.append(list(counts.values()))
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(found, pa.list_(pa.int32())),
                pa.array(times, pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "terms", "times"])

    return counted


class Segment:
    """Impact lists of some documents, and their postings by document."""

    def __init__(self, sizes, counts, term, times, weights, documents: int, words: int):
        sizes = np.asarray(sizes, np.int64)
        doc = np.repeat(np.arange(len(sizes)), counts)
        middle = 50 + 50 * sizes * documents // words
        times = times.astype(np.int64)
        impact = weights[term] * (1_000_000_000 * times // (1000 * times + 20 * middle[doc]))
        order = np.lexsort((-impact, term))
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.list_docs, self.list_impacts = doc[order], impact[order]
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        self.term, self.impact = term, impact
        self.ends = np.cumsum(counts)
        self.counts = np.asarray(counts, np.int64)
        self.seen = np.zeros(len(order) + 1, bool)
        self.asked = np.zeros(len(weights), bool)
        self.met = np.zeros(len(sizes), bool)

    def best(self, asked: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores): all with at least the larger of ``floor`` and the k-th score."""
        lists = [(s, e) for s, e in zip(self.starts[asked], self.starts[asked + 1], strict=True) if e > s]
        best = [s for s, _ in lists]
        self.asked[asked] = True
        docs, scores, step = [], [], FIRST
        kept = np.zeros(0, np.int64)
        while True:
            limit = 0
            for i, (_, end) in enumerate(lists):
                while best[i] < end and self.seen[best[i]]:
                    run = self.seen[best[i] : min(end, best[i] + 4096)]
                    best[i] += len(run) if run.all() else int(run.argmin())
                limit += int(self.list_impacts[best[i]]) if best[i] < end else 0
            kth = max(floor, int(kept.min()) if len(kept) == k else 1)
            if limit < kth:
                break
            places = np.concatenate([np.arange(b, min(b + step, e)) for b, (_, e) in zip(best, lists, strict=True)])
            new = np.unique(self.list_docs[places[~self.seen[places]]])
            # Direct access: all postings of the documents just met.
            counts, ends = self.counts[new], np.cumsum(self.counts[new])
            at = np.repeat(self.ends[new] - ends, counts) + np.arange(ends[-1])
            mine = self.asked[self.term[at]]
            totals = np.add.reduceat(np.where(mine, self.impact[at], 0), ends - counts)
            self.seen[self.place[at[mine]]] = True
            docs.append(new)
            scores.append(totals)
            kept = np.concatenate([kept, totals])
            kept = np.partition(kept, len(kept) - k)[-k:] if len(kept) > k else kept
            step *= 2
        self.asked[asked] = False
        for start, end in lists:
            self.seen[start:end] = False
        docs, scores = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (docs, scores))
        high = scores >= kth
        return docs[high], scores[high]


class Best:
    """The best k (doc_id, score) of an item so far; documents without id come last."""

    def __init__(self, k: int):
        self.k = k
        self.ids, self.lost, self.scores = np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, lost: np.ndarray, scores: np.ndarray) -> None:
        ids, lost, scores = (
            np.concatenate(x) for x in ((self.ids, ids), (self.lost, lost), (self.scores, scores))
        )
        order = np.lexsort((ids, lost, -scores))[: self.k]
        self.ids, self.lost, self.scores = ids[order], lost[order], scores[order]


def _searched(items, weights, documents: int, words: int, k: int, segment: int):
    """The k best documents of each item among those of a task."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = items.value, weights.value
        found = [Best(k) for _ in asked]
        part = -1

        def answer(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            lists = table.column("terms").combine_chunks()
            lost = table.column("doc_id").is_null().to_numpy()
            ids = table.column("doc_id").fill_null(0).to_numpy()
            counts = lists.value_lengths().to_numpy()
            times = table.column("times").combine_chunks().flatten().to_numpy()
            own = Segment(table.column("size").to_numpy(), counts, lists.flatten().to_numpy(), times, weight, documents, words)
            for numbers, best in zip(asked, found, strict=True):
                docs, scores = own.best(numbers, k, best.floor)
                if len(docs):
                    best.add(ids[docs], lost[docs], scores)

        held, postings = [], 0
        for batch in batches:
            if not len(batch):
                continue
            part = batch.column("part")[0].as_py()
            held.append(batch)
            postings += pc.sum(batch.column("terms").value_lengths()).as_py()
            if postings >= segment:
                answer(held)
                held, postings = [], 0
        if held:
            answer(held)
        for item, best in enumerate(found):
            if len(best.ids):
                columns = [
                    pa.array(np.full(len(best.ids), item, np.int32)),
                    pa.array(best.ids, mask=best.lost),
                    pa.array(best.scores),
                    pa.array(np.full(len(best.ids), part, np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score", "part"])

    return searched


def _first(found: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best rows of each key, numbered."""
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 50,
    block_terms: int = 1 << 18,
    segment: int = SEGMENT,
    item_col: str = "item_id",
    item_text_col: str = "text",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """item_id, rank from 1, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    asked = only(items, item_id=item_col, text=item_text_col).withColumn("item_id", F.col("item_id").cast("long"))
    asked = asked.mapInArrow(_item_terms, "item_id long, terms array<string>")
    asked = written(asked.select("item_id", F.explode("terms").alias("term")).distinct(), "item-terms")
    blocks = max(1, -(-asked.count() // block_terms))
    cols = only(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    results = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).groupBy("item_id")
        own = own.agg(F.sort_array(F.collect_list("term")).alias("terms")).orderBy("item_id").collect()
        numbers = {t: i for i, t in enumerate(sorted({t for r in own for t in r["terms"]}))}
        sent = spark.sparkContext.broadcast(numbers)
        schema = "doc_id long, size long, terms array<int>, times array<int>"
        counted = written(cols.mapInArrow(_counted(sent), schema), "counted")
        documents, words = counted.agg(F.count_if(F.col("size") > 0), F.sum("size")).first()
        holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(numbers), np.int64)
        for term, count in holding:
            weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * count + 1)))
        lists = [np.array([numbers[t] for t in r["terms"]], np.int64) for r in own]
        find = _searched(
            spark.sparkContext.broadcast(lists), spark.sparkContext.broadcast(weights), documents, words or 1, k, segment
        )
        matching = counted.where(F.size("terms") > 0).withColumn("part", F.spark_partition_id())
        found = matching.mapInArrow(find, FOUND)
        found = _first(found, k, "item", (F.col("part") / MERGED).cast("int").alias("__part")).drop("rank")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(own)], "item int, item_id long")
        results.append(_first(found, k, "item").join(names, "item").select("item_id", "rank", "doc_id", "score"))
    out = results[0]
    for other in results[1:]:
        out = out.unionByName(other)
    return out
