"""Language-model scores by online logistic context mixing.

A text is its UTF-8 bytes with A-Z lower-cased, cut into tokens: words, and white space
other than the single space between two words, and an end mark. A token is a path of
binary choices: frequent ones (at most ``COMMON``) are leaves of one Huffman tree;
the others are its escape leaf and then their bytes, leaves of a second tree. For each
choice several contexts look up a bit predictor, how often that choice went which way:

- tokens: no context, a hash of the ending of the token before, and the token before
  itself (of a rare token its ending again);
- bytes of rare tokens: none, and hashes of the last one to four bytes, counted over
  different tokens.

A gated mixer adds the stretched probabilities with weights chosen by how much the longer
contexts have seen and by the place in the path; an adaptive map refines the sum by
what followed such sums. The score is the log10 probability of all choices.

The counts of (token before, token) are gathered from all training texts, so they grow
with the corpus; they are partitioned by the token before, of which each has at most
``COMMON`` rows. A predictor is a sum over a stretch of such rows, as rows are sorted by their
code in the tree. Weights learn online: each task reads its choices once, mini-batch by
mini-batch, each predicted from every other time it came up in the corpus, and corrects its
weights after each batch; weights of the tasks are averaged by how much they saw, the
counts of the map added up. A text's score depends on the text and the model alone.

Texts are cut into tokens once for all that follows the vocabulary. Scoring prices the
different pairs of the texts; at most ``PRICED`` frequent ones are broadcast. The others, and
rare tokens, meet their prices in buckets by hash, of about ``BUCKET`` pairs or tokens, as
lists; their nats come back in lists by the part that a row is in. Byte contexts are hashed to
2^20 predictors.

The base score is a unigram model with add-one counts over words. Counts of words
that are not frequent are joined.

Defined results: null is empty and scored for its end mark; rows that repeat a doc_id are
documents of their own; without training texts all choices start even, and base scores
are 0; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ofertario.llm.common import map_texts, only, release
from ofertario.session import written

#: Most leaves of the token tree; classes of endings; most pairs whose price is broadcast.
COMMON, CLASSES, PRICED = 1 << 17, 32, 1 << 20
#: Bits of a token in the key of a pair.
SHIFT = 18
#: Bytes of text cut into tokens at once; pairs and bytes worked on at once; words remembered.
PART, PAIRS, BYTES, REMEMBERED = 1 << 20, 1 << 13, 1 << 16, 1 << 18
#: Pairs that come to the blocks at once.
ROWS = 10_000
#: Pairs gathered in a task before they are added up; rows sent from a worker at once.
GATHERED, SENT = 1 << 21, 1 << 16
#: Training tokens whose pairs a task learns from, about.
TAUGHT = 1 << 21
#: Pairs whose prices are looked up together, about; rows whose nats are added up together.
BUCKET, PART_ROWS = 1 << 18, 1 << 10
#: Orders of the byte contexts and bits of their hashes.
ORDERS, SLOT_BITS = 4, 20
#: Orders whose counts choose the gate.
GATED = (2, 3, 4)
#: Weights that learning starts from, by order.
START = [0.05, 0.05, 0.15, 0.3, 0.45]
#: Leaf of the end of a spelled token; what stands before its first byte.
STOP, BEFORE = 256, 257
MAP_STEPS, RATE, PRIOR = 33, 0.02, 0.4
TOKEN = re.compile(rb"[^ \t-\r]+|[ \t-\r]{2,}|[\t-\r]|\A | \Z")
BLANK = re.compile(rb"[ \t-\r]")
IS_BLANK = np.array([BLANK.match(bytes([b])) is not None for b in range(256)])


def parts(raw: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``PART`` bytes; a single space between words is left out."""
    start = 0
    while len(raw) - start > 2 * PART:
        cut = raw.find(b" ", start + PART)
        while 0 < cut < len(raw) - 1 and (BLANK.match(raw, cut - 1) or BLANK.match(raw, cut + 1)):
            cut = raw.find(b" ", cut + 1)
        if not 0 < cut < len(raw) - 1:
            break
        yield raw[start:cut]
        start = cut + 1
    yield raw[start:]


def tokens_of(text: str | None) -> Iterator[list[bytes]]:
    """The tokens of a text in pieces; its end mark is not among them."""
    for part in parts((text or "").encode().lower()):
        yield TOKEN.findall(part)


def tokens_in(texts: list[str | None]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """The tokens of texts as ``tokens_of`` gives them, many at a time, and how many of them
    each text has."""
    pieces, owners, size = [], [], 0
    for i, text in enumerate(texts):
        for piece in parts((text or "").encode().lower()):
            pieces.append(piece)
            owners.append(i)
            size += len(piece)
            if size >= 2 * PART:
                yield _cut_up(pieces, owners, len(texts))
                pieces, owners, size = [], [], 0
    if pieces:
        yield _cut_up(pieces, owners, len(texts))


def _cut_up(pieces: list[bytes], owners: list[int], texts: int) -> tuple[pa.Array, np.ndarray]:
    data = np.frombuffer(b"".join(pieces), np.uint8)
    ends = np.cumsum([len(p) for p in pieces])
    blank = IS_BLANK.take(data)
    outer = np.zeros(len(data) + 1, bool)
    outer[0] = outer[ends] = True
    edge = outer.copy()
    edge[1:-1] |= blank[1:] != blank[:-1]
    at = np.flatnonzero(edge)
    start, size = at[:-1], np.diff(at)
    # A single space between words is no token.
    left_out = (size == 1) & (data.take(start) == 32) & ~outer.take(start) & ~outer.take(at[1:])
    stays = np.ones(len(data), bool)
    stays[start[left_out]] = False
    start, size = start[~left_out], size[~left_out]
    offsets = np.r_[0, np.cumsum(size)].astype(np.int32)
    found = pa.Array.from_buffers(
        pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[stays]))]
    )
    in_piece = np.diff(np.r_[0, np.searchsorted(start, ends)])
    return found, np.bincount(owners, in_piece, texts).astype(np.int64)


def ending(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % CLASSES


@cache
def ending_table() -> np.ndarray:
    """``ending`` by the last byte, and by the last two behind."""
    one = [ending(bytes([b])) for b in range(256)]
    return np.array(one + [ending(bytes([a, b])) for a in range(256) for b in range(256)], np.int32)


def ends_of(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The ``ending`` of each token, none of which is empty, and whether it is a word."""
    offsets = np.frombuffer(tokens.buffers()[1], np.int32)[tokens.offset :][: len(tokens) + 1]
    data = np.frombuffer(tokens.buffers()[2], np.uint8)
    start, stop = offsets[:-1], offsets[1:]
    last, size = data.take(stop - 1).astype(np.int64), stop - start
    place = np.where(size > 1, 256 + (data.take(np.maximum(stop - 2, 0)).astype(np.int64) << 8) + last, last)
    return ending_table().take(place), ~IS_BLANK.take(data.take(start))


def code_lengths(weights: np.ndarray) -> np.ndarray:
    """Depths of a Huffman tree's leaves."""
    floor = max(1, int(weights.sum()) >> 26)
    heap = [(max(int(w), floor), i) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    parent, nodes = {}, len(weights)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        parent[a[1]] = parent[b[1]] = nodes
        heapq.heappush(heap, (a[0] + b[0], nodes))
        nodes += 1
    depth = np.zeros(nodes, np.int64)
    for node in range(nodes - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    return depth[: len(weights)]


class Tree:
    """A Huffman tree with leaves in the order of their codes.

    At depth d the path of leaf r goes through a node with the leaves lo[d, r] to
    hi[d, r]; those from mid[d, r] are behind its branch 1."""

    def __init__(self, lengths: np.ndarray):
        self.given = lengths
        self.order = np.lexsort((np.arange(len(lengths)), lengths))
        self.length = lengths[self.order]
        self.deep = deep = int(self.length.max(initial=0))
        width = np.int64(1) << (deep - self.length)
        self.code = np.cumsum(width) - width
        leaves = np.arange(len(lengths))
        shape = (deep, len(lengths))
        self.lo, self.mid, self.hi = (np.zeros(shape, np.int32) for _ in range(3))
        for d in range(deep):
            prefix = self.code >> (deep - d)
            starts = np.flatnonzero(np.r_[True, prefix[1:] != prefix[:-1]])
            ends = np.r_[starts[1:], len(leaves)]
            zeros = np.add.reduceat(1 - (self.code >> (deep - d - 1) & 1), starts)
            run = np.repeat(np.arange(len(starts)), ends - starts)
            self.lo[d], self.hi[d] = starts[run], ends[run]
            self.mid[d] = (starts + zeros)[run]

    def __reduce__(self):
        return Tree, (self.given,)


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    up, down = ones.astype(np.float32), zeros.astype(np.float32)
    return np.log((up + np.float32(PRIOR)) / (down + np.float32(PRIOR)))


def level(n: np.ndarray, most: int) -> np.ndarray:
    return np.minimum(np.frexp(n.astype(np.float32))[1], most)


class Mixer:
    """Weights by gate, and a map by level from sums to what followed them."""

    def __init__(self, gates: int, start: list[float], levels: int):
        self.weights = np.tile(np.array(start), (gates, 1))
        self.squares = np.full(self.weights.shape, 1e-4)
        self.mass = np.zeros(gates)
        self.seen = np.zeros((levels, MAP_STEPS, 2))

    @staticmethod
    def bins(total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (np.minimum(np.maximum(total, -8), 7.999) + 8) * ((MAP_STEPS - 1) / 16)
        low = at.astype(np.int32)
        return low, at - low

    def sums(self, inputs: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = sum(x * w.take(gate) for x, w in zip(inputs, self.weights.T.astype(np.float32), strict=True))
        return np.minimum(np.maximum(total, -20), 20)

    def learn(self, inputs, gate, lev, bit, times) -> None:
        """One mini-batch: predicted first, then learned from."""
        total = self.sums(inputs, gate)
        wrong = (bit - 1 / (1 + np.exp(-total))) * times
        gates = len(self.weights)
        mass = np.bincount(gate, times, gates)
        scale = 1 / np.sqrt(np.maximum(mass, 1))
        for k, x in enumerate(inputs):
            slope = np.bincount(gate, wrong * x, gates) * scale
            self.squares[:, k] += slope * slope
            self.weights[:, k] += RATE * slope / np.sqrt(self.squares[:, k])
        self.mass += mass
        low, part = self.bins(total)
        flat = self.seen.reshape(-1)
        at = (lev * MAP_STEPS + low) * 2 + bit
        flat += np.bincount(at, times * (1 - part), flat.size) + np.bincount(at + 2, times * part, flat.size)

    def cost(self, inputs, gate, lev, bit) -> np.ndarray:
        """Nats of choices."""
        total = self.sums(inputs, gate)
        toward = np.where(bit == 1, total, -total).astype(float)
        p = 1 / (1 + np.exp(-toward))
        centre = 1 / (1 + np.exp(8 - np.arange(MAP_STEPS) * (16 / (MAP_STEPS - 1))))
        refined = ((self.seen[..., 1] + 20 * centre) / (self.seen.sum(axis=2) + 20)).ravel()
        low, part = self.bins(total)
        at = lev * MAP_STEPS + low
        mapped = refined.take(at) * (1 - part) + refined.take(at + 1) * part
        p = 0.5 * p + 0.5 * np.where(bit == 1, mapped, 1 - mapped)
        return -np.log(np.maximum(p, 1e-7))

    def state(self) -> np.ndarray:
        return np.concatenate([(self.weights * self.mass[:, None]).ravel(), self.mass, self.seen.ravel()])

    def put(self, state: np.ndarray) -> None:
        """The state of all tasks added up: averaged weights, all counts of the map."""
        n, gates = self.weights.size, len(self.mass)
        self.mass, sums = state[n : n + gates], state[:n].reshape(self.weights.shape)
        met = self.mass > 0
        self.weights[met] = sums[met] / self.mass[met, None]
        self.seen = state[n + gates :].reshape(self.seen.shape)


class Vocabulary:
    """The frequent tokens and the tree over them; END and ESCAPE are leaves, too."""

    def __init__(self, counts: dict[bytes, int], rare: int, tree: Tree | None = None):
        self.made_of = counts, rare
        names = [b"", None, *sorted(t for t in counts if t)]
        weights = np.array([counts.get(b"", 0) + 1, rare + 1, *[counts[t] for t in names[2:]]], np.int64)
        self.tree = tree or Tree(code_lengths(weights))
        names = [names[i] for i in self.tree.order]
        self.end, self.escape = names.index(b""), names.index(None)
        self.leaf = {t: i for i, t in enumerate(names) if t is not None}
        self.counts = weights[self.tree.order]
        #: What training counted, one more; leaves that are words or the end.
        self.given = np.array([counts.get(t, 0) + 1 for t in names])
        self.is_word = np.array([t is not None and not BLANK.match(t) for t in names])
        #: The ending of each token before; contexts beyond the leaves are endings.
        self.kind = np.array([*[ending(t or b"") for t in names], *range(CLASSES)], np.int64)

    def __reduce__(self):
        return Vocabulary, (*self.made_of, self.tree)

    def pairs(self, found: list[bytes], before: int) -> tuple[np.ndarray, np.ndarray, list[bytes], int]:
        """Keys of (token before, token), leaves, rare tokens, and the last context."""
        leaves = np.fromiter(map(self.leaf.get, found, repeat(-1)), np.int64, len(found))
        places = np.flatnonzero(leaves < 0)
        rare = [found[i] for i in places]
        contexts = leaves.copy()
        contexts[places] = [len(self.counts) + ending(t) for t in rare]
        leaves[places] = self.escape
        keys = np.r_[before, contexts[:-1]][: len(found)] << SHIFT | leaves
        return keys, leaves, rare, int(contexts[-1]) if len(found) else before


def packed(counts: np.ndarray) -> tuple[bytes, str, tuple[int, ...]]:
    """Counts to be sent: most are small or 0."""
    return zlib.compress(counts.tobytes(), 1), counts.dtype.str, counts.shape


def unpacked(data: bytes, kind: str, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), kind).reshape(shape)


class Contexts:
    """What the choices of a token need of the vocabulary: the tree and the endings, no names."""

    def __init__(self, tree: Tree, kind: np.ndarray):
        self.tree, self.kind = tree, kind


def _tokens(contexts: Contexts, by_class, mixer: Mixer) -> Tokens:
    return Tokens(contexts, (unpacked(*counts) for counts in by_class), mixer)


def _letters(tree: Tree, counts, mixer: Mixer) -> Letters:
    return Letters(tree, unpacked(*counts), mixer)


class Tokens:
    """Predictors and mixer of tokens after tokens."""

    GATES, LEVELS = 8 * 3 * 4, 8

    def __init__(self, vocabulary: Vocabulary | Contexts, by_class, mixer: Mixer | None = None):
        # Class by class and depth by depth: each worker builds this, and holds it once.
        self.vocabulary = vocabulary
        tree = vocabulary.tree
        self.sums = np.zeros((CLASSES, len(tree.length) + 1), np.int64)
        for counts, sums in zip(by_class, self.sums, strict=True):
            np.cumsum(counts, out=sums[1:])
        whole = self.sums.sum(axis=0)
        self.plain = np.zeros(tree.mid.shape, np.float32)
        for plain, lo, mid, hi in zip(self.plain, tree.lo, tree.mid, tree.hi, strict=True):
            middle = whole.take(mid)
            plain[:] = stretched(middle - whole.take(lo), whole.take(hi) - middle)
        self.mixer = mixer or Mixer(self.GATES, [0.3, 0.2, 0.6], self.LEVELS)

    def __reduce__(self):
        contexts = Contexts(self.vocabulary.tree, self.vocabulary.kind)
        return _tokens, (contexts, [packed(np.diff(sums)) for sums in self.sums], self.mixer)

    def steps(self, keys: np.ndarray, seen: np.ndarray, apart: int):
        """Choices of a sorted block of whole contexts, depth by depth. Tokens whose paths
        have been the same so far make one choice: yields the first row of each, whether it
        is the second branch of its node (the first stands right before it), inputs, gates,
        levels, bits, and how often. ``apart`` is taken from each choice's own counts."""
        tree = self.vocabulary.tree
        leaf, context = keys & ((1 << SHIFT) - 1), keys >> SHIFT
        row, code = self.vocabulary.kind[context] * self.sums.shape[1], tree.code[leaf]
        differ = np.frexp((code[1:] ^ code[:-1]).astype(float))[1]
        shared = np.r_[-1, np.where(context[1:] == context[:-1], tree.deep - differ, -1)]
        length, summed, sums = tree.length.take(leaf), np.r_[0, np.cumsum(seen)], self.sums.ravel()
        for d in range(tree.deep):
            heads = np.flatnonzero(shared <= d)
            n = np.diff(summed.take(np.r_[heads, len(keys)]))
            more = np.flatnonzero(length.take(heads) > d)
            if not len(more):
                return
            heads, n = heads.take(more), n.take(more)
            at, at_row = leaf.take(heads), row.take(heads)
            mid = tree.mid[d].take(at)
            bit = (at >= mid).astype(np.int32)
            second = np.flatnonzero(shared.take(heads) == d)
            other = np.zeros(len(n), np.int64)
            other[second], other[second - 1] = n[second - 1], n[second]
            ones, zeros = np.where(bit == 1, n, other), np.where(bit == 1, other, n)
            middle = sums.take(at_row + mid)
            class_zeros = middle - sums.take(at_row + tree.lo[d].take(at))
            class_ones = sums.take(at_row + tree.hi[d].take(at)) - middle
            if apart:
                own = np.minimum(n, apart)
                own_up = own * bit
                own_down = own - own_up
                ones, zeros = ones - own_up, zeros - own_down
                class_ones, class_zeros = class_ones - own_up, class_zeros - own_down
            last = stretched(zeros, ones)
            inputs = (self.plain[d].take(at), stretched(class_zeros, class_ones), last)
            lev = level(zeros + ones, 7)
            sure = np.where((ones == 0) | (zeros == 0), 2, np.abs(last) > 2)
            yield heads, second, inputs, (lev * 3 + sure) * 4 + min(d // 4, 3), lev, bit, n

    def learn(self, keys: np.ndarray, seen: np.ndarray) -> None:
        for _, _, inputs, gate, lev, bit, n in self.steps(keys, seen, 1):
            self.mixer.learn(inputs, gate, lev, bit, n.astype(float))

    def price(self, keys: np.ndarray, seen: np.ndarray) -> np.ndarray:
        nats = np.zeros(len(keys))
        for heads, second, *choices, _ in self.steps(keys, seen, 0):
            spent = nats.take(heads)
            spent[second] = spent[second - 1]
            nats[heads] = spent + self.mixer.cost(*choices)
        return nats


class Letters:
    """Predictors and mixer of the bytes of rare tokens."""

    GATES, LEVELS = 4**3 * 3, 12

    def __init__(self, tree: Tree, counts: np.ndarray | None = None, mixer: Mixer | None = None):
        self.tree = tree
        self.leaf = np.argsort(self.tree.order)
        draw = np.random.default_rng(5)
        self.odd = [np.uint64(int(x) * 2 + 1) for x in draw.integers(2**62, size=ORDERS + 1)]
        self.counts = np.zeros((2, 1 << SLOT_BITS), np.int64) if counts is None else counts
        self.both = None
        self.mixer = mixer or Mixer(self.GATES, START, self.LEVELS)

    def __reduce__(self):
        return _letters, (self.tree, packed(self.counts), self.mixer)

    def steps(self, spelled: list[bytes]):
        """Choices depth by depth: the token of each, its slots and bits."""
        sizes = np.array([len(t) + 1 for t in spelled])
        owner = np.repeat(np.arange(len(spelled)), sizes)
        text = np.full(len(owner) + ORDERS, BEFORE, np.uint64)
        ends = np.cumsum(sizes) - 1
        inside = np.ones(len(owner), bool)
        inside[ends] = False
        text[ORDERS:][inside] = np.frombuffer(b"".join(spelled), np.uint8)
        text[ORDERS:][ends] = STOP
        place = np.arange(len(owner)) - np.r_[0, ends[:-1] + 1][owner]
        hashes, h = [], np.zeros(len(owner), np.uint64)
        for k in range(ORDERS + 1):
            if k:
                before = np.where(place >= k, text[ORDERS - k : len(text) - k], BEFORE).astype(np.uint64)
                h = (h ^ (before + np.uint64(k << 10))) * self.odd[k]
                h ^= h >> np.uint64(29)
            hashes.append(h)
        leaf = self.leaf[text[ORDERS:].astype(np.int64)]
        rows = np.arange(len(owner))
        for d in range(self.tree.deep):
            rows = rows[self.tree.length[leaf[rows]] > d]
            if not len(rows):
                return
            at = leaf[rows]
            nodes = (self.tree.lo[d].astype(np.uint64) << np.uint64(10)) + self.tree.hi[d].astype(np.uint64)
            node = nodes.take(at)
            slots = [
                (((x[rows] + node) * self.odd[0]) >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for x in hashes
            ]
            yield d, owner[rows], slots, (at >= self.tree.mid[d].take(at)).astype(np.int32)

    def count(self, spelled: list[bytes], into: np.ndarray) -> None:
        flat = into.reshape(-1)
        for _, _, slots, bit in self.steps(spelled):
            branch = bit.astype(np.int64) << SLOT_BITS
            for s in slots:
                np.add.at(flat, s + branch, 1)

    def seen(self, d, slots, bit, own):
        """Inputs, gates and levels; ``own`` is taken from each choice's counts."""
        if self.both is None:
            # Both counts of a slot side by side.
            self.both = (self.counts[0] + 1j * self.counts[1]).astype(np.complex64)
        inputs, totals = [], []
        for s in slots:
            found = self.both.take(s)
            zeros, ones = found.real, found.imag
            if own is not None:
                zeros, ones = np.maximum(zeros - own * (1 - bit), 0), np.maximum(ones - own * bit, 0)
            inputs.append(stretched(zeros, ones))
            totals.append(zeros + ones)
        levels = [level(totals[k], 6) // 2 for k in GATED]
        gate = ((levels[2] * 4 + levels[1]) * 4 + levels[0]) * 3 + min(d // 2, 2)
        return inputs, gate, levels[2] * 3 + min(d // 2, 2)

    def learn(self, spelled: list[bytes], times: np.ndarray) -> None:
        for d, owner, slots, bit in self.steps(spelled):
            own = (times[owner] == 1).astype(np.int64)
            inputs, gate, lev = self.seen(d, slots, bit, own)
            self.mixer.learn(inputs, gate, lev, bit, times[owner].astype(float))

    def price(self, spelled: list[bytes]) -> np.ndarray:
        nats = np.zeros(len(spelled))
        for d, owner, slots, bit in self.steps(spelled):
            inputs, gate, lev = self.seen(d, slots, bit, None)
            nats += np.bincount(owner, self.mixer.cost(inputs, gate, lev, bit), len(nats))
        return nats


def in_bytes(spelled: list[bytes]) -> Iterator[tuple[int, int]]:
    """Stretches of a list with about ``BYTES`` bytes."""
    start = size = 0
    for i, t in enumerate(spelled):
        size += len(t) + 1
        if size >= BYTES:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(spelled):
        yield start, len(spelled)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _in_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A long batch in parts, so that nothing holds all of it on its way."""
    for start in range(0, batch.num_rows, SENT):
        yield batch.slice(start, SENT)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of tokens, b'' for the end; they leave in parts."""
    held: list[pa.RecordBatch] = []

    def once() -> pa.RecordBatch:
        sums = pa.Table.from_batches(held).group_by("token").aggregate([("n", "sum")]).combine_chunks()
        return _batch(token=sums["token"].combine_chunks(), n=sums["n_sum"].combine_chunks())

    ends = 0
    for batch in batches:
        for tokens, _ in tokens_in(batch.column("text").to_pylist()):
            token, n = tokens.value_counts().flatten()
            held.append(_batch(token=token, n=n))
            if sum(x.num_rows for x in held) > REMEMBERED:
                held = [once()]
                if held[0].num_rows > REMEMBERED // 2:
                    yield held.pop()
        ends += batch.num_rows
    held.append(_batch(token=pa.array([b""], pa.binary()), n=pa.array([ends], pa.int64())))
    yield once()


def _added_up(found: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Different keys, sorted, and how often each came up in a stretch of a task."""
    held, size = np.zeros(GATHERED, np.int64), 0

    def stretch(n: int) -> tuple[np.ndarray, np.ndarray]:
        held[:n].sort()
        starts = np.flatnonzero(np.r_[True, held[1:n] != held[: n - 1]])
        return held.take(starts), np.diff(np.r_[starts, n])

    for keys in found:
        for start in range(0, len(keys), GATHERED):
            some = keys[start : start + GATHERED]
            if size + len(some) > GATHERED:
                yield stretch(size)
                size = 0
            held[size : size + len(some)] = some
            size += len(some)
    if size:
        yield stretch(size)


def _pairs(shared):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of (token before, token), added up within stretches of a task."""
        vocabulary = shared.value

        def found() -> Iterator[np.ndarray]:
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    before = vocabulary.end
                    for piece in tokens_of(text):
                        keys, _, _, before = vocabulary.pairs(piece, before)
                        yield keys
                    yield np.array([before << SHIFT | vocabulary.end])

        for keys, n in _added_up(found()):
            yield from _in_slices(_batch(key=pa.array(keys), n=pa.array(n)))

    return pairs


def _cut(shared):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts as the contexts that their tokens are, and their rare tokens."""
        vocabulary, total, distinct = shared.value
        leaves = len(vocabulary.counts)
        leaf_of = {None: vocabulary.escape, **vocabulary.leaf}
        names = pa.array(sorted(leaf_of, key=leaf_of.get), pa.binary())
        is_word = np.r_[vocabulary.is_word, np.zeros(CLASSES, bool)]
        logs = np.where(is_word, np.r_[np.log10(vocabulary.given / (total + distinct + 1)), np.zeros(CLASSES)], 0)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if not texts:
                continue
            found, rare, named, n = [], [pa.array([], pa.binary())], [], np.zeros(len(texts), np.int64)
            for tokens, n_here in tokens_in(texts):
                if not len(tokens):
                    continue
                coded = tokens.dictionary_encode()
                which = coded.indices.to_numpy()
                leaf = pc.index_in(coded.dictionary, value_set=names).fill_null(-1).to_numpy()
                kinds, is_named = ends_of(coded.dictionary)
                contexts = np.where(leaf < 0, leaves + kinds, leaf).astype(np.int32).take(which)
                is_rare = contexts >= leaves
                found.append(contexts)
                rare.append(tokens.filter(pa.array(is_rare)))
                named.append(is_named.take(which[is_rare]))
                n += n_here
            ends = np.cumsum(n + 1)
            contexts, inside = np.full(ends[-1], vocabulary.end, np.int32), np.ones(ends[-1], bool)
            inside[ends - 1] = False
            contexts[inside] = np.concatenate([np.zeros(0, np.int32), *found])
            starts = np.r_[0, ends[:-1]]
            of = np.searchsorted(ends, np.flatnonzero(contexts >= leaves), "right")
            n_common = np.add.reduceat(is_word.take(contexts).astype(np.int64), starts)
            n_named = np.bincount(of[np.concatenate([np.zeros(0, bool), *named])], minlength=len(texts))
            yield _batch(
                doc_id=batch.column("doc_id"),
                teaches=batch.column("teaches"),
                size=pa.array([len((t or "").encode()) + 1 for t in texts], pa.int64()),
                n_common=pa.array(n_common if total else n_common * 0),
                n_tokens=pa.array(n_common + n_named),
                base_common=pa.array(np.add.reduceat(logs.take(contexts), starts)),
                contexts=_lists(np.r_[0, ends], pa.array(contexts)),
                rare=_lists(np.r_[0, np.cumsum(np.bincount(of, minlength=len(texts)))], pa.concat_arrays(rare)),
            )

    return cut


def _keys(batch: pa.RecordBatch, end: int, escape: int, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of (token before, token) of cut texts, and the row of each."""
    lists = batch.column("contexts")
    contexts = lists.flatten().to_numpy().astype(np.int64)
    of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    # Each text ends with the end mark, which stands before the first token of the next.
    return np.r_[end, contexts[:-1]][: len(contexts)] << SHIFT | np.where(contexts < leaves, contexts, escape), of


def _asked(end: int, escape: int, leaves: int, tasks: int):
    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of pairs of cut texts, by task; the last bit of a key says whether the text teaches."""

        def found() -> Iterator[np.ndarray]:
            for batch in batches:
                keys, of = _keys(batch, end, escape, leaves)
                yield keys << 1 | batch.column("teaches").to_numpy(zero_copy_only=False).astype(np.int64)[of]

        for keys, n in _added_up(found()):
            yield _by_task(keys, n, tasks)

    return asked


def _known(tasks: int):
    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of training, in the same form."""
        for batch in batches:
            if batch.num_rows:
                yield _by_task(batch.column("key").to_numpy() << 1 | 1, batch.column("n").to_numpy(), tasks)

    return known


def _by_task(keys: np.ndarray, n: np.ndarray, tasks: int) -> pa.RecordBatch:
    task = _bucket(keys >> 1 + SHIFT, tasks)
    order = np.argsort(task, kind="stable")
    task = task[order]
    bounds = _runs(task)
    return _batch(
        task=pa.array(task[bounds[:-1]].astype(np.int32)),
        keys=_lists(bounds, pa.array(keys[order])),
        n=_lists(bounds, pa.array(n[order])),
    )


def _sum_up(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = np.concatenate(keys), np.concatenate(n)
    order = np.argsort(keys)
    keys, n = keys[order], n[order]
    starts = _runs(keys)[:-1]
    return keys[starts], np.add.reduceat(n, starts) if len(starts) else n


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a task in the order of their keys; what is held grows with the different ones."""
    keys, n, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for batch in batches:
        keys.append(batch.column("keys").flatten().to_numpy())
        n.append(batch.column("n").flatten().to_numpy())
        size += len(keys[-1])
        if size > GATHERED:
            once = _sum_up(keys, n)
            keys, n, size = [once[0]], [once[1]], 0
    tagged, times = _sum_up(keys, n)
    del keys, n
    bounds = _runs(tagged >> 1)
    first = bounds[:-1]
    if not len(first):
        return
    taught = np.add.reduceat(times * (tagged & 1), first)
    both = (tagged[first] >> 1, taught, np.add.reduceat(times, first))
    for start in range(0, len(first), SENT):
        some = [x[start : start + SENT] for x in both]
        yield _batch(**{c: _lists(np.array([0, len(x)]), pa.array(x)) for c, x in zip(("keys", "n", "asked"), some, strict=True)})


def _rows(batches: Iterator[pa.RecordBatch], taught: bool) -> Iterator[pa.RecordBatch]:
    """The pairs of ``_together`` as rows, ``ROWS`` at once; if ``taught``, those of training."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        columns = [batch.column(c).flatten().to_numpy() for c in ("keys", "n", "asked")]
        held.append([c[columns[1] > 0] for c in columns] if taught else columns)
        size += len(held[-1][0])
        if size >= ROWS:
            whole = [np.concatenate(c) for c in zip(*held, strict=True)]
            for start in range(0, size - ROWS + 1, ROWS):
                yield _batch(**{c: pa.array(x[start : start + ROWS]) for c, x in zip(batch.schema.names, whole, strict=True)})
            size %= ROWS
            held = [[c[len(c) - size :] for c in whole]]
    if size:
        whole = [np.concatenate(c) for c in zip(*held, strict=True)]
        yield _batch(**{c: pa.array(x) for c, x in zip(("keys", "n", "asked"), whole, strict=True)})


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Columns of rows sorted by key, in blocks of whole contexts of about ``PAIRS`` rows."""
    held: list[list[np.ndarray]] = []
    size = 0
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held.append(columns)
        size += len(columns[0])
        if size < PAIRS:
            continue
        whole = [np.concatenate(c) for c in zip(*held, strict=True)]
        context = whole[0] >> SHIFT
        starts = np.r_[0, np.flatnonzero(context[1:] != context[:-1]) + 1]
        begin = 0
        for start in starts[1:]:
            if start - begin >= PAIRS:
                yield [c[begin:start] for c in whole]
                begin = start
        if begin == 0 and len(starts) > 1:
            begin = starts[-1]
            yield [c[:begin] for c in whole]
        held = [[c[begin:] for c in whole]]
        size = len(held[0][0])
    if size:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def _state(mixer: Mixer) -> pa.RecordBatch:
    state = mixer.state()
    at = np.flatnonzero(state)
    return _batch(slot=pa.array(at, pa.int32()), value=pa.array(state[at], pa.float64()))


def _learn_tokens(shared):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = shared.value
        tokens.mixer = Mixer(tokens.GATES, [0.3, 0.2, 0.6], tokens.LEVELS)
        for keys, seen, _ in blocks(_rows(batches, True)):
            tokens.learn(keys, seen)
        yield _state(tokens.mixer)

    return learn


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
    return (mixed % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int32)


def _runs(*ids: np.ndarray) -> np.ndarray:
    """Where runs of the same ids begin, and the end of the last."""
    n = len(ids[0])
    same = np.logical_and.reduce([x[1:] == x[:-1] for x in ids])
    return np.r_[0, np.flatnonzero(~same) + 1, n] if n else np.zeros(1, np.int64)


def _lists(bounds: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)


def _price_tokens(shared, often: int, buckets: int):
    def price(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Prices in buckets by key; bucket -1 has those asked ``often``."""
        held: list[tuple[np.ndarray, ...]] = []

        def rows() -> pa.RecordBatch:
            bucket, keys, nats = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(bucket, kind="stable")
            bounds = _runs(bucket := bucket[order])
            return _batch(
                bucket=pa.array(bucket[bounds[:-1]]),
                keys=_lists(bounds, pa.array(keys[order])),
                nats=_lists(bounds, pa.array(nats[order])),
            )

        for keys, seen, asked in blocks(_rows(batches, False)):
            wanted = asked > 0
            nats = shared.value.price(keys, seen)[wanted].astype(np.float32)
            keys = keys[wanted]
            held.append((np.where(asked[wanted] >= often, -1, _bucket(keys, buckets).astype(np.int32)), keys, nats))
            if sum(len(h[0]) for h in held) > GATHERED // 4:
                yield rows()
        if held:
            yield rows()

    return price


def _count_letters(shared):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros(shared.value.counts.shape, np.int64)
        for batch in batches:
            spelled = batch.column("token").to_pylist()
            for a, b in in_bytes(spelled):
                shared.value.count(spelled[a:b], into)
        flat = into.reshape(-1)
        at = np.flatnonzero(flat)
        yield from _in_slices(_batch(slot=pa.array(at, pa.int32()), n=pa.array(flat[at], pa.int64())))

    return count


def _learn_letters(shared):
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = shared.value
        letters.mixer = Mixer(letters.GATES, START, letters.LEVELS)
        for batch in batches:
            spelled, times = batch.column("token").to_pylist(), batch.column("n").to_numpy()
            for a, b in in_bytes(spelled):
                letters.learn(spelled[a:b], times[a:b])
        yield _state(letters.mixer)

    return learn


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(STOP + 1, np.int64)
    for batch in batches:
        spelled = batch.column("token").to_pylist()
        seen[:STOP] += np.bincount(np.frombuffer(b"".join(spelled), np.uint8), minlength=STOP)
        seen[STOP] += len(spelled)
    yield _batch(slot=pa.array(range(STOP + 1), pa.int32()), n=pa.array(seen, pa.int64()))


def array_of(rows: DataFrame, size: int, kind) -> np.ndarray:
    """Sums of values by slot; there are ``size`` slots at most."""
    slot, value = rows.columns
    table = rows.groupBy(slot).agg(F.sum(value).alias(value)).toArrow()
    out = np.zeros(size, kind)
    out[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return out


def least(rows: DataFrame, count: str, most: int) -> int:
    """The smallest count that at most ``most`` rows reach."""
    step = F.floor(F.log2(count) * 16)
    lowest, left = math.inf, most
    for _, n, low in sorted(map(tuple, rows.groupBy(step).agg(F.count("*"), F.min(count)).collect()), reverse=True):
        left -= n
        if left < 0:
            break
        lowest = low
    return int(min(lowest, 2**62))


@contextmanager
def shared_out(df: DataFrame, value):
    """A broadcast that goes as soon as what needs it is written or collected."""
    out = df.sparkSession.sparkContext.broadcast(value)
    yield out
    out.destroy()


class Model:
    """What scoring needs. ``pairs`` stay in files; the rest is of bounded size."""

    def __init__(self, tokens: Tokens, letters: Letters, pairs: DataFrame, total: int, distinct: int):
        self.tokens, self.letters, self.pairs = tokens, letters, pairs
        self.total, self.distinct = total, distinct


def by_context(pairs: DataFrame, tasks: int) -> DataFrame:
    """keys, n, asked: the counts of each pair in lists in the order of the codes; a task has
    all of a token before, at most ``COMMON``. Kept on disk, as learning and prices need the
    same rows."""
    together = pairs.repartition(tasks, "task").mapInArrow(_together, "keys array<long>, n array<long>, asked array<long>")
    return together.persist(StorageLevel.DISK_ONLY)


BY_TASK = "task int, keys array<long>, n array<long>"


class Words:
    """What counting tells of the tokens: the frequent ones, the others, and all words."""

    def __init__(self, texts: DataFrame):
        counted = map_texts(texts, _count, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
        counted = written(counted, "tokens")
        self.words = counted.where(~is_blank("token"))
        self.total, self.distinct = map(int, self.words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first())
        often = max(2, least(counted, "n", COMMON - 2))
        is_common = (F.col("n") >= often) | (F.length("token") == 0)
        common = {bytes(r["token"]): r["n"] for r in counted.where(is_common).collect()}
        self.rare = counted.where(~is_common)
        self.bytes = array_of(self.rare.mapInArrow(_count_bytes, "slot int, n long"), STOP + 1, np.int64)
        self.vocabulary = Vocabulary(common, self.rare.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def is_blank(token: str):
    return F.substring(token, 1, 1).isin(*[bytes([b]) for b in (32, *range(9, 14))])


def learned_tokens(pairs: DataFrame, vocabulary: Vocabulary) -> Tokens:
    """Learns from the counts of pairs by context."""
    with shared_out(pairs, vocabulary.kind) as shared:
        counts = class_counts(pairs, len(vocabulary.counts), shared)
    tokens = Tokens(vocabulary, counts)
    with shared_out(pairs, tokens) as shared:
        learned = pairs.mapInArrow(_learn_tokens(shared), "slot int, value double")
        tokens.mixer.put(array_of(learned, len(tokens.mixer.state()), float))
    return tokens


def learned_letters(rare: DataFrame, seen: np.ndarray) -> Letters:
    letters = Letters(Tree(code_lengths(seen + 1)))
    with shared_out(rare, letters) as shared:
        slots = rare.mapInArrow(_count_letters(shared), "slot int, n long")
        letters.counts = array_of(slots, letters.counts.size, np.int64).reshape(letters.counts.shape)
    with shared_out(rare, letters) as shared:
        learned = rare.mapInArrow(_learn_letters(shared), "slot int, value double")
        letters.mixer.put(array_of(learned, len(letters.mixer.state()), float))
    return letters


def train(docs: DataFrame, text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the counts of all training words (token, n)."""
    texts = only(docs, text=text_col)
    known = Words(texts)
    with shared_out(docs, known.vocabulary) as shared:
        pairs = map_texts(texts, _pairs(shared), "key long, n long")
        pairs = written(pairs.groupBy("key").agg(F.sum("n").alias("n")), "pairs")
    tasks = 1 + known.total // TAUGHT
    together = by_context(pairs.mapInArrow(_known(tasks), BY_TASK), tasks)
    tokens = learned_tokens(together, known.vocabulary)
    together.unpersist()
    return Model(tokens, learned_letters(known.rare, known.bytes), pairs, known.total, known.distinct), known.words


def class_counts(pairs: DataFrame, leaves: int, shared) -> np.ndarray:
    """Counts of tokens after each ending."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        into = np.zeros(CLASSES * leaves, np.int64)
        for batch in batches:
            keys, n = (batch.column(c).flatten().to_numpy() for c in ("keys", "n"))
            np.add.at(into, shared.value.take(keys >> SHIFT) * leaves + (keys & ((1 << SHIFT) - 1)), n)
        for kind, counts in enumerate(into.reshape(CLASSES, leaves)):
            at = np.flatnonzero(counts)
            ends = np.array([0, len(at)])
            yield _batch(
                kind=pa.array([kind], pa.int32()),
                leaf=_lists(ends, pa.array(at.astype(np.int32))),
                n=_lists(ends, pa.array(counts[at])),
            )

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for kind, leaf, n in zip(*(batch.column(c) for c in ("kind", "leaf", "n")), strict=True):
                counts = sums.setdefault(kind.as_py(), np.zeros(leaves, np.int64))
                counts[leaf.values.to_numpy()] += n.values.to_numpy()
        for kind, counts in sums.items():
            yield _batch(kind=pa.array([kind], pa.int32()), n=_lists(np.array([0, leaves]), pa.array(counts)))

    found = pairs.mapInArrow(add, "kind int, leaf array<int>, n array<long>").repartition("kind")
    rows = found.mapInArrow(total, "kind int, n array<long>").toArrow()
    out = np.zeros((CLASSES, leaves), np.int64)
    if rows.num_rows:
        out[rows.column(0).to_numpy()] = _flat(rows.column(1)).reshape(-1, leaves)
    return out


def _look_up(shared):
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nats of frequent pairs by row, and the other pairs, in buckets by key and parts by row."""
        known, prices, end, escape, leaves, buckets = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, of = _keys(batch, end, escape, leaves)
            order = np.argsort(keys)
            asked = keys[order]
            at = np.minimum(np.searchsorted(known, asked), max(0, len(known) - 1))
            hit = known[at] == asked if len(known) else np.zeros(len(asked), bool)
            rows = batch.column("row").to_numpy()
            part, place = rows // PART_ROWS, (rows % PART_ROWS).astype(np.int32)
            # Without any value, bincount gives whole numbers.
            nats = np.bincount(of[order[hit]], prices[at[hit]], len(rows)).astype(float)
            bounds = _runs(part)
            n = len(bounds) - 1
            yield _batch(
                bucket=pa.array((part[bounds[:-1]] % buckets).astype(np.int32)),
                part=pa.array(part[bounds[:-1]]),
                places=_lists(bounds, pa.array(place)),
                keys=_lists(np.zeros(n + 1, np.int32), pa.array([], pa.int64())),
                nats=_lists(bounds, pa.array(nats)),
            )
            left = np.sort(order[~hit])
            keys, of = keys[left], of[left]
            bucket = _bucket(keys, buckets)
            # Rows are in order, so those of a part stay together within a bucket.
            order = np.argsort(bucket, kind="stable")
            bucket, keys, of = bucket[order], keys[order], of[order]
            bounds = _runs(bucket, part[of])
            first = bounds[:-1]
            n = len(first)
            yield _batch(
                bucket=pa.array(bucket[first].astype(np.int32)),
                part=pa.array(part[of[first]]),
                places=_lists(bounds, pa.array(place[of])),
                keys=_lists(bounds, pa.array(keys)),
                nats=_lists(np.zeros(n + 1, np.int32), pa.array([], pa.float64())),
            )

    return look_up


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy()


def _bounds(column: pa.ChunkedArray) -> np.ndarray:
    return np.r_[0, np.cumsum(pc.list_value_length(column).to_numpy())].astype(np.int64)


def _by_place(asked: pa.Table, lists: str, **values: np.ndarray) -> pa.Table:
    """Sums of values by part and place; ``asked`` has the places of a part together."""
    parts, bounds = asked["part"].to_numpy(), _bounds(asked[lists])
    places, at = _flat(asked[lists]), np.repeat(np.arange(len(parts)), np.diff(bounds))
    first = _runs(at, places)[:-1]
    bounds = np.searchsorted(at[first], np.arange(len(parts) + 1))
    sums = {c: _lists(bounds, pa.array(np.add.reduceat(x, first) if len(first) else x)) for c, x in values.items()}
    return pa.table({"part": pa.array(parts), "places": _lists(bounds, pa.array(places[first])), **sums})


def _priced(asked: pa.Table, prices: pa.Table) -> pa.Table:
    """Nats of a bucket's pairs by part and place."""
    nats = np.zeros(len(_flat(asked["places"])))
    to_price = np.repeat(np.diff(_bounds(asked["keys"])) > 0, np.diff(_bounds(asked["places"])))
    keys = _flat(prices["keys"])
    order = np.argsort(keys)
    nats[to_price] = _flat(prices["nats"])[order].take(np.searchsorted(keys[order], _flat(asked["keys"])))
    nats[~to_price] = _flat(asked["nats"])
    return _by_place(asked, "places", nats=nats)


def _spread(buckets: int):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rare tokens in buckets and parts by row."""
        for batch in batches:
            lists, rows = batch.column("rare"), batch.column("row").to_numpy()
            tokens = lists.flatten()
            of = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
            bucket = np.array([zlib.crc32(t) % buckets for t in tokens.to_pylist()], np.int32)
            order = np.argsort(bucket, kind="stable")
            bucket, of = bucket[order], of[order]
            part, place = rows[of] // PART_ROWS, (rows[of] % PART_ROWS).astype(np.int32)
            bounds = _runs(bucket, part)
            yield _batch(
                bucket=pa.array(bucket[bounds[:-1]]),
                part=pa.array(part[bounds[:-1]]),
                places=_lists(bounds, pa.array(place)),
                tokens=_lists(bounds, tokens.take(pa.array(order))),
            )

    return spread


def _price_rare(shared, floor: float):
    def price(asked: pa.Table, words: pa.Table) -> pa.Table:
        """What a bucket's rare tokens cost by part and place; each is priced once."""
        coded = asked["tokens"].combine_chunks().flatten().dictionary_encode()
        different, which = coded.dictionary, coded.indices.to_numpy()
        met = pc.index_in(different, value_set=words["token"].combine_chunks())
        n = words["n"].combine_chunks().take(met).fill_null(0).to_numpy(zero_copy_only=False)
        spelled = different.to_pylist()
        nats = np.concatenate([np.zeros(0), *[shared.value.price(spelled[a:b]) for a, b in in_bytes(spelled)]])
        named = np.array([not BLANK.match(t) for t in spelled], bool)
        return _by_place(
            asked,
            "places",
            n_rare=(n > 0).astype(np.int64).take(which),
            base_rare=np.where(named, np.log10((n + 1) / floor), 0.0).take(which),
            nats_rare=nats.take(which),
        )

    return price


def _summed(*columns: str):
    def summed(found: pa.Table) -> pa.Table:
        """Sums of each row of a part."""
        places = _flat(found["places"])
        place = np.unique(places).astype(np.int64)
        sums = {c: pa.array(np.bincount(places, _flat(found[c]), PART_ROWS).astype(float)[place]) for c in columns}
        return pa.table({"row": pa.array(found["part"][0].as_py() * PART_ROWS + place), **sums})

    return summed


def cut(docs: DataFrame, vocabulary: Vocabulary, total: int, distinct: int) -> DataFrame:
    """Texts (doc_id, text, teaches) cut into tokens, once: row, doc_id, teaches, size, n_common,
    n_tokens, base_common, contexts, rare."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, teaches boolean, size long, n_common long, n_tokens long, base_common double,"
        " contexts array<int>, rare array<binary>"
    )
    with shared_out(docs, (vocabulary, total, distinct)) as shared:
        found = map_texts(docs, _cut(shared), schema)
        return written(found.withColumn("row", F.monotonically_increasing_id()), "cut")


def pairs_of(texts: DataFrame, vocabulary: Vocabulary, tasks: int) -> DataFrame:
    """Counts of the pairs of cut texts by task, added up within tasks only."""
    asked = _asked(vocabulary.end, vocabulary.escape, len(vocabulary.counts), tasks)
    return texts.select("contexts", "teaches").mapInArrow(asked, BY_TASK)


def token_nats(texts: DataFrame, pairs: DataFrame, tokens: Tokens, end: int, escape: int) -> DataFrame:
    """Nats of the choices among frequent tokens: row, nats."""
    asked = pairs.mapInArrow(_how_often, "n long, pairs long").groupBy("n").agg(F.sum("pairs").alias("pairs"))
    often, left, different = 2**62, PRICED, 0
    for n, some in sorted(map(tuple, asked.collect()), reverse=True):
        different, left = different + some, left - some
        often = n if left >= 0 else often
    buckets = 1 + different // BUCKET
    with shared_out(texts, tokens) as shared:
        prices = pairs.mapInArrow(_price_tokens(shared, often, buckets), "bucket int, keys array<long>, nats array<float>")
        prices = written(prices, "prices")
    pairs.unpersist()
    release(texts.sparkSession)
    frequent = prices.where("bucket < 0").select("keys", "nats").toArrow()
    keys, nats = _flat(frequent.column(0)), _flat(frequent.column(1))
    order = np.argsort(keys)
    with shared_out(texts, (keys[order], nats[order], end, escape, len(tokens.vocabulary.tree.length), buckets)) as shared:
        schema = "bucket int, part long, places array<int>, keys array<long>, nats array<double>"
        looked = texts.select("row", "contexts").mapInArrow(_look_up(shared), schema)
        schema = "part long, places array<int>, nats array<double>"
        others = prices.where("bucket >= 0")
        found = looked.groupBy("bucket").cogroup(others.groupBy("bucket")).applyInArrow(_priced, schema)
        return written(found.groupBy("part").applyInArrow(_summed("nats"), "row long, nats double"), "nats")


def rare_sums(texts: DataFrame, words: DataFrame, letters: Letters, floor: float) -> DataFrame:
    """Of rare tokens: row, n_rare, base_rare, nats_rare."""
    buckets = 1 + texts.agg(F.coalesce(F.sum(F.size("rare")), F.lit(0))).first()[0] // BUCKET
    sums = "n_rare {0}, base_rare {1}, nats_rare {1}"
    with shared_out(texts, letters) as shared:
        found = texts.select("row", "rare").mapInArrow(
            _spread(buckets), "bucket int, part long, places array<int>, tokens array<binary>"
        )
        known = words.select("token", "n", (F.crc32("token") % buckets).cast("int").alias("bucket"))
        priced = found.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(
            _price_rare(shared, floor), "part long, places array<int>, " + sums.format("array<long>", "array<double>")
        )
        rows = priced.groupBy("part").applyInArrow(
            _summed("n_rare", "base_rare", "nats_rare"), "row long, " + sums.format("double", "double")
        )
        return written(rows.withColumn("n_rare", F.col("n_rare").cast("long")), "rare")


def _how_often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many pairs are asked how often."""
    found: Counter = Counter()
    for batch in batches:
        n, pairs = np.unique(batch.column("asked").flatten().to_numpy(), return_counts=True)
        found.update(dict(zip(n.tolist(), pairs.tolist(), strict=True)))
    yield _batch(n=pa.array(found.keys(), pa.int64()), pairs=pa.array(found.values(), pa.int64()))


def _scores(texts: DataFrame, pairs: DataFrame, words: DataFrame, model: Model) -> DataFrame:
    vocabulary, zero = model.tokens.vocabulary, F.lit(0.0)
    nats = token_nats(texts, pairs, model.tokens, vocabulary.end, vocabulary.escape)
    release(texts.sparkSession)
    rare = rare_sums(texts, words, model.letters, float(model.total + model.distinct + 1))
    release(texts.sparkSession)
    spent = F.col("nats") + F.coalesce("nats_rare", zero)
    return texts.drop("contexts", "rare", "teaches").join(nats, "row").join(rare, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_common") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base_common") + F.coalesce("base_rare", zero)).alias("base_score"),
        (-spent / math.log(10)).alias("score"),
        (spent / math.log(2) / F.col("size")).alias("bits_per_byte"),
    )


def score(docs: DataFrame, model: Model, words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    vocabulary = model.tokens.vocabulary
    cols = only(docs, doc_id=id_col, text=text_col).withColumn("teaches", F.lit(False))
    texts = cut(cols, vocabulary, model.total, model.distinct)
    tokens = texts.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    tasks = 1 + max(tokens, model.total) // TAUGHT
    known = model.pairs.select("key", "n").mapInArrow(_known(tasks), BY_TASK)
    asked = pairs_of(texts, vocabulary, tasks)
    pairs = by_context(known.unionByName(asked), tasks)
    return _scores(texts, pairs, words, model)


def train_and_score(docs: DataFrame, apart: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``score`` of all documents by ``train`` of those that are not ``apart``; texts are cut and
    pairs gathered once for both."""
    cols = docs.select(
        docs[f"`{id_col}`"].alias("doc_id"), docs[f"`{text_col}`"].alias("text"), F.coalesce(~apart, F.lit(False)).alias("teaches")
    )
    known = Words(cols.where("teaches").select("text"))
    texts = cut(cols, known.vocabulary, known.total, known.distinct)
    tasks = 1 + known.total // TAUGHT
    pairs = by_context(pairs_of(texts, known.vocabulary, tasks), tasks)
    tokens = learned_tokens(pairs, known.vocabulary)
    letters = learned_letters(known.rare, known.bytes)
    return _scores(texts, pairs, known.words, Model(tokens, letters, pairs, known.total, known.distinct))
