from __future__ import annotations

import pickle
import tracemalloc
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from ofertario.llm import lm


def test_lm_counts_each_pair_and_learns_from_every_choice(spark):
    draw = np.random.default_rng(2)
    texts = [" ".join(map(str, draw.integers(300, size=150))) + "\n \t" for _ in range(40)]
    model, words = lm.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    vocabulary = model.tokens.vocabulary
    expected: Counter = Counter()
    for text in texts:
        found = [t.encode() for t in text.split()] + [b"\n \t"]
        for before, token in zip([b"", *found], [*found, b""], strict=True):
            leaf = {**vocabulary.leaf, b"": vocabulary.end}
            context = leaf.get(before, len(vocabulary.counts) + lm.ending(before))
            expected[context << lm.SHIFT | leaf.get(token, vocabulary.escape)] += 1
    assert {r.key: r.n for r in model.pairs.collect()} == expected
    assert words.agg({"n": "sum"}).first()[0] == 40 * 151
    choices = sum(n * vocabulary.tree.length[k & ((1 << lm.SHIFT) - 1)] for k, n in expected.items())
    assert round(model.tokens.mixer.mass.sum()) == choices
    assert round(model.tokens.mixer.seen.sum()) == choices


def test_tokens_give_the_text_back():
    for text in ("", " ", "a b", " a b ", "a  b\n\nc \t d", "\n", "x " * 10, "é Ü\u3000z"):
        found = [t for piece in lm.tokens_of(text) for t in piece]
        back = b""
        for i, t in enumerate(found):
            both = i and not lm.BLANK.match(t) and not lm.BLANK.match(found[i - 1])
            back += b" " + t if both else t
        assert back == text.encode().lower()


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"w{i}" + "\n  " * (i % 7 == 0) for i in range(2000))
    whole = [t for piece in lm.tokens_of(text) for t in piece]
    monkeypatch.setattr(lm, "PART", 100)
    pieces = list(lm.tokens_of(text))
    assert len(pieces) > 20 and [t for piece in pieces for t in piece] == whole


def test_workers_get_predictors_without_the_names():
    names = {b"": 9, **{b"w%d" % i: 2 + i % 7 for i in range(500)}}
    vocabulary = lm.Vocabulary(names, 40)
    counts = np.random.default_rng(3).integers(0, 3, (lm.CLASSES, len(vocabulary.counts)))
    tokens = lm.Tokens(vocabulary, counts)
    sent = pickle.dumps(tokens)
    assert b"w499" not in sent
    got = pickle.loads(sent)
    assert (np.diff(got.sums) == counts).all() and (got.plain == tokens.plain).all()
    keys = np.arange(len(vocabulary.counts)) | 5 << lm.SHIFT
    seen = np.ones(len(keys), np.int64)
    assert (got.price(keys, seen) == tokens.price(keys, seen)).all()


def test_predictors_are_built_in_little_more_than_they_hold():
    vocabulary = lm.Vocabulary({b"": 9, **{b"w%d" % i: 2 + 10**6 // (i + 1) for i in range(20_000)}}, 40)
    sent = pickle.dumps(lm.Tokens(vocabulary, np.ones((lm.CLASSES, len(vocabulary.counts)), np.int64)))
    tracemalloc.start()
    got = pickle.loads(sent)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    tree = got.vocabulary.tree
    assert peak < 1.5 * sum(x.nbytes for x in (got.sums, got.plain, tree.lo, tree.mid, tree.hi))


def test_gathered_pairs_leave_in_slices(monkeypatch):
    monkeypatch.setattr(lm, "GATHERED", 50)
    monkeypatch.setattr(lm, "SENT", 7)
    vocabulary = lm.Vocabulary({b"": 9, b"a": 5, b"b": 4, b"c": 3}, 2)
    draw = np.random.default_rng(4)
    texts = [None, "", "a", *[" ".join(draw.choice(list("abcde"), size=n)) for n in (49, 50, 51, 200, 3)]]
    expected: Counter = Counter()
    for text in texts:
        before = vocabulary.end
        for piece in lm.tokens_of(text):
            keys, _, _, before = vocabulary.pairs(piece, before)
            expected.update(keys.tolist())
        expected[before << lm.SHIFT | vocabulary.end] += 1
    batches = [pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])]
    got: Counter = Counter()
    for batch in lm._pairs(SimpleNamespace(value=vocabulary))(iter(batches)):
        assert 0 < batch.num_rows <= 7
        for key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[key] += n
    assert got == expected
    assert list(lm._pairs(SimpleNamespace(value=vocabulary))(iter([]))) == []
