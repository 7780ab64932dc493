from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ofertario.llm import language, licenses, lm, nearest, pii

from llm_helpers import text_of, words_of

PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def passes(kind: str, s: str) -> bool:
    digits = [int(d) for d in re.sub("[^0-9]", "", s)]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_spans(text: str) -> list[str]:
    return [
        f"{k}:{m.start()}:{m.end()}" for k, p in PII for m in re.finditer(p, text) if passes(k, m.group())
    ]


TRICKY = [
    "a@b.co@c.de x@y é@z.fr .%+@-.-", "1.2.3.4.5 256.1.1.1 1.2.3 007.08.09.010", "4111 1111-1111 1111 4111111111111112",
    "+1 (017) 555-7713 +12 +123456789012345678 ++4 20 1234 5678", "😀 me@x.org 😀 10.0.0.1", "9" * 5000 + ".1.1.1", "",
]


def test_base_spans_equal_the_patterns():
    draw = random.Random(3)
    made = ["".join(draw.choice("ab1 2.@+-(4)é%") for _ in range(60)) for _ in range(3000)]
    for text in [*TRICKY[:5], *made, *TRICKY[6:]]:
        got = [f"{k}:{a}:{b}" for k, a, b in pii.base_spans(text)]
        assert got == brute_spans(text)
    assert pii.base_spans(TRICKY[5]) == []


def test_base_spans_of_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000 + "1" * 300_000 + "@" * 1000) == []


@pytest.fixture(scope="module")
def weights(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return pii.train(table)


def test_added_spans_overlap_nothing_and_find_other_writings(docs, rows, weights):
    got = pii.scan(docs, weights).toPandas()
    assert len(got) == len(rows)
    texts = Counter(text_of(t) for t in rows.text)
    for text in texts:
        base, added = pii.find(text, weights)
        assert pii.in_order(base) == ",".join(brute_spans(text))
        spans = sorted((a, b) for _, a, b in base)
        for _, a, b in added:
            assert not any(a < y and x < b for x, y in spans)
    found = pii.find("thand the (415) 555-2671 onthe token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" est", weights)[1]
    assert {k for k, _, _ in found} >= {"secret"}


def test_clean_text_stays_clean(weights):
    for text in ("Chapter 12 of 1999, section 4.2 and 3 more.", "The 2353820953013749 other.", "no digits at all"):
        assert pii.find(text, weights) == ([], [])


def test_pii_of_nothing(empty):
    assert pii.scan(empty, pii.train(empty)).count() == 0


def test_license_places(docs, rows):
    got = licenses.label(docs).toPandas()
    split = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans(licenses.UPPER, licenses.LOWER)
    expected = Counter()
    for text in rows.text:
        words, places, labels = split.findall(text_of(text).translate(lower)), [], set()
        for phrase, name in licenses.BASE:
            of = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(of)] == of]
            places += at
            labels |= {name} if at else set()
        ends = (min(places), max(places)) if places else (-1, -1)
        expected[(len(words), len(places), *ends, ",".join(sorted(labels)))] += 1
    got[["first_word", "last_word"]] = got[["first_word", "last_word"]].fillna(-1)
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels"]
    assert Counter(got[columns].itertuples(index=False, name=None)) == expected
    for r in got.itertuples():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


def test_notices_match_with_words_put_in_or_left_out(spark):
    notice = licenses.NOTICES[-4][0].split()
    texts = {
        1: " ".join(notice),
        2: " ".join(["Some", "words:", *notice[:4], "EXTRA", *notice[4:], "end"]),
        3: " ".join([*notice[:6], *notice[7:]]),
        4: " ".join(notice[:4]),
        5: " ".join(reversed(notice)),
    }
    got = licenses.label(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    found = {r.doc_id: r.labels for r in got.collect()}
    assert found == {1: "mit", 2: "mit", 3: "mit", 4: "", 5: ""}


def test_licenses_of_nothing(empty):
    assert licenses.label(empty).count() == 0


def test_language_accuracy_on_held_out_rows(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    apart = language.held_out(F.col("doc_id"), 3, 1)
    got = language.predict(table, language.fit(table.where(~apart))).join(table, "doc_id").where(apart).toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all() and got.rejected.mean() < 0.01


def test_language_on_edge_cases(docs, rows, empty):
    model = language.fit(docs)
    got = language.predict(docs, model).toPandas()
    assert len(got) == len(rows)
    no_letter = {d for d, t in zip(rows.doc_id, rows.text, strict=True) if not any(map(str.isalpha, text_of(t)))}
    assert set(got[got.lang_pred == "und"].doc_id) == no_letter
    assert (got[got.lang_pred == "und"].score == 0).all() and got[got.lang_pred == "und"].rejected.all()
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(
        t for t in rows.text if t is not None and any(map(str.isalpha, t)) and not rejected(t, model)
    )
    assert language.fit(empty) is None
    assert {r.lang_pred for r in language.predict(docs, None).collect()} == {"und"}


def rejected(text: str, model: language.Centroids) -> bool:
    near = model.centres @ dense(model, text)
    return near.max() < model.least[near.argmax()]


def dense(model: language.Centroids, text: str) -> np.ndarray:
    places, found = language.counts(text, language.letters_table())
    out = np.zeros(language.DIM, np.float32)
    out[places] = model.vector(places, found)
    return out


def test_foreign_script_is_rejected(docs, spark):
    model = language.fit(docs)
    frame = spark.createDataFrame([(1, "Съешь же ещё этих мягких французских булок да выпей чаю")], "doc_id long, text string")
    assert language.predict(frame, model).first().rejected


@pytest.fixture(scope="module")
def scored(docs):
    apart = language.held_out(F.col("doc_id"), 7, 2)
    model, words = lm.train(docs.where(~apart))
    return lm.score(docs, model, words).toPandas(), model


def test_base_score(scored, rows):
    got, model = scored
    counts: Counter = Counter()
    for d, t in zip(rows.doc_id, rows.text, strict=True):
        if zlib.crc32(str("" if pd.isna(d) else int(d)).encode()) % 7 != 2:
            counts.update([*[w.lower() for w in words_of(t)], b""])
    total, floor = sum(counts.values()), sum(counts.values()) + len(counts) + 1
    expected = []
    for t in rows.text:
        words = [*[w.lower() for w in words_of(t)], b""]
        base = sum(math.log10((counts[w] + 1) / floor) for w in words)
        expected.append((len(words), sum(counts[w] > 0 for w in words), round(base, 6)))
    assert sorted(expected) == sorted(zip(got.n_tokens, got.n_known, got.base_score.round(6), strict=True))
    assert (got.train_tokens == total).all()


def test_the_mixing_model_is_a_distribution(scored):
    """Over all tokens after a token, and all bytes after the same bytes, probabilities
    add up to one."""
    _, model = scored
    leaves = len(model.tokens.vocabulary.counts)
    pairs = model.pairs.toPandas().set_index("key").n
    for context in (model.tokens.vocabulary.end, int(pairs.idxmax()) >> lm.SHIFT, leaves + 3):
        keys = np.arange(leaves) | context << lm.SHIFT
        nats = model.tokens.price(keys, pairs.reindex(keys, fill_value=0).to_numpy())
        assert np.exp(-nats).sum() == pytest.approx(1, abs=1e-6)
    ends = [b"th" + bytes([b]) for b in range(256)]
    after = model.letters.price([*ends, b"th"]) - np.r_[stops_of(model.letters, ends), 0]
    begun = model.letters.price([b"th"])[0] - stops_of(model.letters, [b"th"])[0]
    assert np.exp(begun - after).sum() == pytest.approx(1, abs=1e-6)


def stops_of(letters, spelled):
    """Nats of the end mark of each token alone."""
    out = np.zeros(len(spelled))
    for d, owner, slots, bit in letters.steps(spelled):
        last = np.r_[owner[1:] != owner[:-1], True]
        deep = letters.tree.length[letters.leaf[lm.STOP]]
        if d < deep:
            inputs, gate, lev = letters.seen(d, slots, bit, None)
            out[owner[last]] += letters.mixer.cost(inputs, gate, lev, bit)[last]
    return out


def test_pair_prices_equal_a_plain_mixer(scored):
    """Choice by choice, with counts summed over all pairs below each node."""
    _, model = scored
    tokens, tree = model.tokens, model.tokens.vocabulary.tree
    pairs = model.pairs.toPandas().set_index("key").n.sort_index()
    kind, mask = tokens.vocabulary.kind, (1 << lm.SHIFT) - 1
    context, leaf = pairs.index.to_numpy() >> lm.SHIFT, pairs.index.to_numpy() & mask
    got = dict(zip(pairs.index, tokens.price(pairs.index.to_numpy(), pairs.to_numpy()), strict=True))
    mixer = tokens.mixer
    for key in pairs.index[:: max(1, len(pairs) // 25)]:
        own, at, nats = int(key) >> lm.SHIFT, int(key) & mask, 0.0
        for d in range(tree.length[at]):
            lo, mid, hi = tree.lo[d, at], tree.mid[d, at], tree.hi[d, at]
            inputs = []
            for rows in (np.ones(len(pairs), bool), kind[context] == kind[own], context == own):
                zeros = pairs[rows & (leaf >= lo) & (leaf < mid)].sum()
                ones = pairs[rows & (leaf >= mid) & (leaf < hi)].sum()
                inputs.append(math.log((ones + lm.PRIOR) / (zeros + lm.PRIOR)))
            lev = min(int(zeros + ones).bit_length(), 7)
            sure = 2 if zeros == 0 or ones == 0 else int(abs(inputs[2]) > 2)
            gate = (lev * 3 + sure) * 4 + min(d // 4, 3)
            one = np.array([1 if at >= mid else 0])
            nats += mixer.cost(np.array(inputs)[:, None], np.array([gate]), np.array([lev]), one)[0]
        assert got[key] == pytest.approx(nats, rel=1e-5)


def test_scores_do_not_depend_on_neighbours(scored, docs, spark, rows):
    got, model = scored
    assert (got.score < 0).all()
    texts = [t for t in rows.text.map(text_of) if len(t) < 3000][:20]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    words = spark.createDataFrame([], "token binary, n long")
    alone = [lm.score(frame.where(F.col("doc_id") == i), model, words).first().score for i in (0, 7)]
    together = {r.doc_id: r.score for r in lm.score(frame.coalesce(1), model, words).collect()}
    assert alone == pytest.approx([together[0], together[7]])


def test_held_out_texts_cost_little(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    apart = language.held_out(F.col("doc_id"), 7, 2)
    model, words = lm.train(table.where(~apart))
    got = lm.score(table.where(apart), model, words).toPandas()
    assert got.bits_per_byte.median() < 2.4
    assert got.score.sum() > 1.09 * got.base_score.sum()


def test_lm_of_nothing(empty, docs):
    model, words = lm.train(empty)
    assert lm.score(empty, model, words).count() == 0
    got = lm.score(docs, model, words).toPandas()
    assert (got.train_tokens == 0).all() and (got.n_known == 0).all() and (got.base_score == 0).all()


def brute_neighbours(ids, vectors, asked, k):
    out = {}
    for q in asked:
        own = vectors[ids.index(q)]
        near = [(-sum(a * b for a, b in zip(own, v, strict=True)), i) for i, v in zip(ids, vectors, strict=True) if i != q and len(v) == len(own)]
        out[q] = [i for _, i in sorted(near)[:k]]
    return out


def test_neighbours_are_exact(spark):
    draw = np.random.default_rng(4)
    vectors = draw.integers(-3, 4, size=(700, 6)).astype(float).tolist()
    ids = list(range(700))
    bad = [(1000, None), (1001, [0.0] * 6), (1002, [1.0, None] + [0.0] * 4), (1003, [float("nan")] * 6), (1004, []), (1005, [float("inf")] * 6)]
    rows = [*zip(ids, vectors, strict=True), *bad, (None, [1.0] * 6), (2000, [1.0, 2.0]), (2020, [2.0, 2.0]), (5, vectors[5])]
    rows = [(i, v) for i, v in rows if i is None or i >= 1000 or any(v)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("block", F.lit("own"))
    queries = frame.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"))
    good = {i: v for i, v in rows if i is not None and (i < 1000 or i >= 2000)}
    asked = [i for i in good if i % 20 == 0]
    expected = brute_neighbours(list(good), list(good.values()), asked, 20)
    got = nearest.neighbours(frame, queries, k=20, block=32, blocks_in_chunk=4, query_group=8).toPandas()
    found = {q: of.sort_values("rank").vec_id.tolist() for q, of in got.groupby("query_id")}
    assert found == {q: e for q, e in expected.items() if e}


def test_windows_alone_find_some(spark):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 16))
    vectors = (centres[draw.integers(0, 40, 1500)] + 0.2 * draw.normal(size=(1500, 16))).tolist()
    frame = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    queries = frame.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"))
    got = nearest.neighbours(frame, queries, k=10, block=64, complete=False).toPandas()
    exact = nearest.neighbours(frame, queries, k=10, block=64).toPandas()
    both = got.merge(exact, on=["query_id", "vec_id"])
    assert len(both) > 0.9 * len(exact)


def test_hilbert_walks_by_unit_steps():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), axis=-1).reshape(-1, 3)
    keys = nearest.hilbert(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_of_nothing(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<double>")
    queries = frame.select(F.col("vec_id").alias("query_id"))
    assert nearest.neighbours(frame, queries).count() == 0
