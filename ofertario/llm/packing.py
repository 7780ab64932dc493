"""Best-fit decreasing packing of token sequences.

Documents longer than the window are first cut into full windows and a rest.
Pieces are then placed from the longest down, each into the tightest open window
that still holds it, which a segment tree indexed by remaining capacity finds.

Pieces of one length are alike, so the placing works on how many there are of each
length: at most ``window`` numbers, whatever the table's size. It tells, for runs
of pieces of one length, the windows and offsets they go to; pieces find their run
by their rank within the length.

Defined results: a null text is an empty one and gives the end token alone; an
empty table gives no pieces; repeated rows are documents of their own.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ofertario.llm.common import buckets_for, hash_bucket, map_texts, only, sum_before
from ofertario.session import written

WINDOW = 4096
END = 2


def packed_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds(dict):
    """Token ids of a chunk without white space, as little-endian 32-bit integers.

    Chunks that are letters with ASCII marks around them go straight to the
    tokenizer's model; any other chunk goes through the whole tokenizer. At most
    ``most`` chunks are remembered.
    """

    def __init__(self, path: str, most: int = 1_000_000):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model, self.most = self.whole.model, most
        self.pieces: dict[str, bytes] = {}
        self.plain = re.compile(r"[^\W\d_]+|[!-/:-@\[-`{-~]+")
        self.contraction = re.compile(r"'(?:s|t|re|ve|m|ll|d)")
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.bytes_shown = {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}

    def piece(self, text: str) -> bytes:
        found = self.pieces.get(text)
        if found is None:
            shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.bytes_shown)
            ids = [t.id for t in self.model.tokenize(shown)]
            if len(self.pieces) >= self.most:
                self.pieces.clear()
            found = self.pieces[text] = packed_ids(ids)
        return found

    def __missing__(self, chunk: bytes) -> bytes:
        # Letters of ASCII, with a point or comma behind them or not: nothing to look into.
        if chunk.isalpha():
            ids = self.piece(chunk.lower().decode())
        elif chunk[-1:] in (b",", b".") and chunk[:-1].isalpha():
            ids = self.piece(chunk[:-1].lower().decode()) + self.piece(chunk[-1:].decode())
        else:
            ids = self.of_any(chunk)
        if len(self) >= self.most:
            self.clear()
        self[chunk] = ids
        return ids

    def of_any(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        low = text.lower()
        body, mark = (low[:-1], low[-1]) if text[-1] in ".," else (low, "")
        if body.isalpha() and len(low) == len(text) and "Σ" not in text and unicodedata.is_normalized("NFC", text):
            return self.piece(body) + self.piece(mark) if mark else self.piece(body)
        parts = self.plain.findall(low)
        simple = (
            sum(map(len, parts)) == len(low)
            and "<|" not in text
            and not ("'" in low and self.contraction.search(low))
            and all(p.isascii() or p.isalpha() for p in parts)
            and (text.isascii() or (len(low) == len(text) and "Σ" not in text and unicodedata.is_normalized("NFC", text)))
        )
        if simple:
            return b"".join(map(self.piece, parts))
        return packed_ids(self.whole.encode(text, add_special_tokens=False).ids)


#: White space between chunks; other white space is left to the tokenizer.
SPACES = re.compile(rb"[ \n\t\r]+")


def encoder(path: str):
    """text -> ids as little-endian 32-bit integers, as the tokenizer file gives them."""
    known = WordIds(path)

    def encode(text: str) -> bytes:
        raw = text.encode()
        chunks = raw.split() if not OTHER_SPACE.search(raw) else SPACES.split(raw)
        return b"".join(map(known.__getitem__, chunks))

    return encode


OTHER_SPACE = re.compile(rb"[\x0b\x0c]")


def _pieces(path: str, window: int, end: int, keep_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        last = np.array([end], "<u4").tobytes()
        names = ["doc", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
        for batch in batches:
            ids_col, texts = batch.column("doc_id"), batch.column("text").to_pylist()
            rows: list[tuple] = []
            for i, text in enumerate(texts):
                ids = encode(text or "") + last
                tokens = len(ids) // 4
                for start in range(0, tokens, window):
                    part = ids[4 * start : 4 * (start + window)]
                    row = (i, start, len(part) // 4, zlib.crc32(part), tokens)
                    rows.append((*row, part) if keep_ids else row)
            columns = dict(zip(names, map(list, zip(*rows, strict=True)), strict=True)) if rows else {n: [] for n in names}
            arrays = [ids_col.take(pa.array(columns["doc"], pa.int64()))]
            arrays += [pa.array(columns[n], pa.int64()) for n in names[1:5]]
            arrays += [pa.array(columns["ids"], pa.binary())] if keep_ids else []
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names[1:]])

    return cut


class OpenWindows:
    """Open windows by remaining capacity, with a segment tree over the capacities."""

    def __init__(self, window: int):
        self.leaves = 1 << (window + 1 - 1).bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.runs: dict[int, list[list[int]]] = {}

    def _count(self, capacity: int, change: int) -> None:
        i = capacity + self.leaves
        while i:
            self.tree[i] += change
            i //= 2

    def add(self, capacity: int, first: int, count: int) -> None:
        """``count`` windows, numbered from ``first``, with ``capacity`` left."""
        if capacity and count:
            self.runs.setdefault(capacity, []).append([first, count])
            self._count(capacity, count)

    def tightest(self, need: int) -> int | None:
        """The smallest capacity of at least ``need`` that an open window has."""
        i = need + self.leaves
        if self.tree[i]:
            return need
        while i > 1:
            if i % 2 == 0 and self.tree[i + 1]:
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.tree[2 * i] else 2 * i + 1
                return i - self.leaves
            i //= 2
        return None

    def take(self, capacity: int, most: int) -> tuple[int, int]:
        """Up to ``most`` windows of ``capacity``: the first one's number, and how many."""
        first, count = self.runs[capacity][-1]
        taken = min(count, most)
        if taken == count:
            self.runs[capacity].pop()
        else:
            self.runs[capacity][-1] = [first + taken, count - taken]
        self._count(capacity, -taken)
        return first, taken


def best_fit(counts: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, pieces per window, first window, offset).

    ``counts``: pieces by length. Placing one piece after the other by best fit
    fills a window with as many pieces of the length as it holds before the next
    one is touched, as the window just used is the tightest that is left.
    """
    windows, runs, new = OpenWindows(window), [], 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = windows.tightest(length)
            if capacity is None:
                capacity = window
                each = window // length
                full = -(-left // each)
                first, taken = new, full if left % each == 0 else max(1, full - 1)
                new += taken
            else:
                each = capacity // length
                first, taken = windows.take(capacity, max(1, left // each))
            pieces = min(left, taken * each)
            runs.append((length, rank, pieces, min(each, pieces), first, window - capacity))
            used = min(each, pieces)
            windows.add(capacity - used * length, first, taken)
            rank, left = rank + pieces, left - pieces
    return runs


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = WINDOW,
    end: int = END,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset
    and, with ``keep_ids``, ids: the piece's tokens as little-endian 32-bit integers.

    A piece's tokens lie at ``offset`` of sequence ``sequence_id``; the rest of the
    window is padding.
    """
    spark = docs.sparkSession
    cols = only(docs, doc_id=id_col, text=text_col)
    kind = cols.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long"
    cut = map_texts(
        cols, _pieces(tokenizer_path, window, end, keep_ids), schema + ", ids binary" * keep_ids
    )
    pieces = written(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    runs: dict[int, list] = {}
    for length, rank, n, each, first, offset in best_fit(counts, window):
        runs.setdefault(length, []).append((rank, n, each, first, offset))
    # At most ``window`` rows, and a bounded number of runs in each.
    by_length = spark.createDataFrame(
        list(runs.items()),
        "length long, runs array<struct<rank: long, n: long, each: long, first: long, offset: long>>",
    )
    parts = buckets_for(sum(counts.values()))
    ranked = pieces.select(
        "row", "length", F.lit(1).alias("one"), hash_bucket(F.xxhash64("row"), parts).alias("part")
    )
    ranked = sum_before(ranked, ["length"], "part", ["row"], "one", "rank")
    found = F.filter("runs", lambda r: (F.col("rank") >= r["rank"]) & (F.col("rank") < r["rank"] + r["n"]))
    placed = ranked.join(F.broadcast(by_length), "length").withColumn("run", found[0])
    nth = F.col("rank") - F.col("run.rank")
    placed = placed.select(
        "row",
        (F.col("run.first") + F.floor(nth / F.col("run.each"))).cast("long").alias("sequence_id"),
        (F.col("run.offset") + (nth % F.col("run.each")) * F.col("length")).cast("long").alias("offset"),
    )
    return pieces.join(placed, "row").drop("row")
