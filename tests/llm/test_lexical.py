from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from ofertario.llm import lexical

from llm_helpers import text_of

LETTERS = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def brute_terms(text: str) -> list[str]:
    out, word = [], ""
    for c in text + " ":
        if c in LETTERS or ord(c) > 127:
            word += c.lower() if c < "\x80" else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(items: list, docs: list, k: int) -> dict:
    """Every document's score for every item, whole and sorted."""
    counted = [(d, Counter(brute_terms(text_of(t)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in counted]
    documents, words = sum(n > 0 for n in sizes), sum(sizes)
    holding = Counter(t for _, c in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(brute_terms(text_of(text)))
    found = {}
    for item, own in asked.items():
        scores = []
        for (doc, counts), n in zip(counted, sizes, strict=True):
            total = 0
            for t in own & counts.keys():
                weight = math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[t] + 1)))
                middle = 100 - 50 + 50 * n * documents // words
                total += weight * (10**9 * counts[t] // (1000 * counts[t] + 20 * middle))
            if total > 0:
                scores.append((-total, doc is None, doc or 0))
        for rank, (score, lost, doc) in enumerate(sorted(scores)[:k], 1):
            found[item, rank] = (None if lost else doc, -score)
    return found


def got(frame) -> dict:
    rows = frame.collect()
    found = {(r.item_id, r["rank"]): (r.doc_id, r.score) for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize(("k", "segment", "block"), [(50, 1 << 21, 1 << 18), (5, 2000, 200), (3, 1, 1 << 18)])
def test_search_equals_brute_force(docs, rows, spark, k, segment, block):
    """One and several segments, one and several blocks of items, ties and edge rows."""
    texts = [text_of(t) for t in rows.text]
    items = [(i, t[:200]) for i, t in enumerate(texts[:12])]
    items += [(20, "repeated ROW"), (21, None), (22, "!!!"), (23, "nowhere-tobefound99x"), (1, "apache"), (None, "one two")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    listed = [(None if d is None or d != d else int(d), t) for d, t in zip(rows.doc_id.astype(object).where(rows.doc_id.notna(), None), texts, strict=True)]
    assert got(lexical.search(frame, docs.repartition(3), k, block, segment)) == brute(items, listed, k)


def test_random_lists_with_many_ties(spark):
    draw = random.Random(4)
    docs = [(d, " ".join(draw.choices("abcdefgh", k=draw.choice([0, 1, 3, 6])))) for d in range(400)]
    items = [(i, " ".join(draw.sample("abcdefgh", 3))) for i in range(8)]
    frames = (spark.createDataFrame(x, f"{n} long, text string") for x, n in ((items, "item_id"), (docs, "doc_id")))
    assert got(lexical.search(*frames, k=40)) == brute(items, docs, 40)


def test_nothing(empty, docs, spark):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert lexical.search(items, empty).count() == 0
    assert lexical.search(items.where("false"), docs).count() == 0


def test_reading_stops_before_the_lists_end():
    """A rare heavy term settles the best; the frequent term's list is not read through."""
    draw = np.random.default_rng(1)
    size = 20_000
    counts = np.where(np.arange(size) % 1000 == 0, 2, 1)
    term = np.concatenate([[0, 1] if c == 2 else [0] for c in counts])
    segment = lexical.Segment(draw.integers(50, 200, size), counts, term, np.ones(len(term)), np.array([1, 9000]), size, 125 * size)
    met = []
    place = segment.place
    segment.place = type("Places", (), {"__getitem__": lambda _, at: met.append(at) or place[at]})()
    docs, scores = segment.best(np.array([0, 1]), 10, 1)
    assert len(docs) >= 10 and (docs % 1000 == 0).all() and scores.min() > 0
    assert sum(map(len, met)) < size / 4
