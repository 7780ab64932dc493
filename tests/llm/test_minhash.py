from __future__ import annotations

import math
import random

import numpy as np
import pytest

from ofertario.llm import minhash

from llm_helpers import text_of
from test_dedup_and_join import altered, brute_components


def frame_of(spark, texts: dict):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


@pytest.mark.parametrize(("words", "percent"), [(2, 80), (5, 80)])
def test_components_equal_brute_force(spark, words, percent):
    """Tight and chained groups, widespread passages, short texts."""
    draw = random.Random(words)
    texts: dict[int, str] = {}
    passage = [f"p{i}" for i in range(60)]
    for group in range(6):
        base = [f"g{group}x{draw.randrange(400)}" for _ in range(draw.choice([12, 60, 150]))]
        for _ in range(30):
            base = altered(base, 1, draw).split() if group % 2 else base
            texts[draw.randrange(10**6)] = altered(base, draw.randrange(5), draw)
    for _ in range(40):
        own = [f"o{draw.randrange(10**5)}" for _ in range(draw.choice([5, 20, 80]))]
        texts[draw.randrange(10**6)] = " ".join(own + passage)
    texts |= {10**6 + i: t for i, t in enumerate(["", "  ", "one", "ONE", "one two", "a b c", "a b c"])}
    got = minhash.link(frame_of(spark, texts), words=words, percent=percent).toPandas()
    components, sizes = brute_components(texts, words, percent)
    assert dict(zip(got.doc_id, got.component_id, strict=True)) == components
    assert dict(zip(got.doc_id, got.n_shingles, strict=True)) == sizes
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """A loose group whose buckets outlast their heads, with blocks of a few members."""
    monkeypatch.setattr(minhash, "OUTSIDE", 4)
    monkeypatch.setattr(minhash, "MEMBERS", 8)
    draw = random.Random(3)
    base = [f"b{i}" for i in range(80)]
    texts = {i: altered(base, draw.choice([1, 4, 6, 9]), draw) for i in range(150)}
    got = minhash.link(frame_of(spark, texts), words=2, heads=1).toPandas()
    components, _ = brute_components(texts, 2, 80)
    assert len(set(components.values())) > 5
    assert dict(zip(got.doc_id, got.component_id, strict=True)) == components


def test_edge_cases(docs, rows):
    got = minhash.link(docs, words=2).toPandas()
    assert len(got) == len(rows)
    with_id = rows[rows.doc_id.notna()].drop_duplicates("doc_id")
    expected, sizes = brute_components({int(d): text_of(t) for d, t in zip(with_id.doc_id, with_id.text, strict=True)}, 2, 80)
    found = got[got.doc_id.notna()].drop_duplicates("doc_id")
    assert {int(d): int(c) for d, c in zip(found.doc_id, found.component_id, strict=True)} == expected
    assert {int(d): n for d, n in zip(found.doc_id, found.n_shingles, strict=True)} == sizes
    lost = got[got.doc_id.isna()]
    assert lost.component_id.isna().all() and lost.kept.all() and (lost.n_shingles == 3).all()


def test_null_and_repeated_ids(spark):
    texts = [(3, "a b c d e"), (7, "a b c d e"), (7, "something else entirely"), (None, "a b c d e"), (9, None)]
    got = minhash.link(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    found = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in got)
    assert found == [(0, 0, True), (3, 3, True), (7, 3, False), (7, 7, True), (9, 9, True)]


def test_nothing(empty):
    assert minhash.link(empty).count() == 0


def test_signatures_rule_out_only_what_the_posterior_does():
    """The fewest matches, against the beta posterior summed numerically."""
    grid = (np.arange(200_000) + 0.5) / 200_000
    for n, fewest in minhash.least_matches(160, 32, 80, 1e-6).items():
        for m, gone in ((fewest - 1, True), (fewest, False)):
            log = m * np.log(grid) + (n - m) * np.log1p(-grid)
            weight = np.exp(log - log.max())
            posterior = weight[grid >= 0.8].sum() / weight.sum()
            assert math.isfinite(posterior) and (posterior < 1e-6) == gone


def test_minima_agree_as_often_as_sets_do():
    draw = np.random.default_rng(5)
    factors = draw.integers(0, 2**63, 2000, np.uint64) * np.uint64(2) + np.uint64(1)
    terms = draw.integers(0, 2**63, 2000, np.uint64)
    whole = draw.integers(0, 2**63, 9000, np.uint64)
    a, b = whole[:6000], whole[3000:]
    same = minhash.minima(a, factors, terms) == minhash.minima(b, factors, terms)
    assert abs(same.mean() - 3000 / 9000) < 0.05
