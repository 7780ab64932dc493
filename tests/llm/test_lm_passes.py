from __future__ import annotations

from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ofertario.llm import lm

ODD = [None, "", " ", "  ", "a", "a b", " a b ", "a  b\n\nc \t d", "\n", "x " * 10, "é Ü　Z", "\t", "a\n", "\x0b a"]


def test_tokens_of_many_texts_are_those_of_each(monkeypatch):
    monkeypatch.setattr(lm, "PART", 40)
    texts = [*ODD, " ".join(f"w{i}" + "\n  " * (i % 7 == 0) for i in range(300)), *ODD]
    each = [[t for piece in lm.tokens_of(text) for t in piece] for text in texts]
    found, n = [], 0
    for tokens, n_here in lm.tokens_in(texts):
        found += tokens.to_pylist()
        n = n + n_here
    assert found == [t for some in each for t in some]
    assert n.tolist() == [len(some) for some in each]


def test_counts_leave_in_parts(monkeypatch):
    monkeypatch.setattr(lm, "REMEMBERED", 20)
    monkeypatch.setattr(lm, "PART", 30)
    texts = [*ODD, *(" ".join(f"w{i % 50}" for i in range(j, j + 40)) for j in range(20))]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])] * 2
    got: Counter = Counter()
    for batch in lm._count(iter(batches)):
        for token, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            got[token] += n
    each = Counter(t for text in texts for piece in lm.tokens_of(text) for t in piece)
    assert got == Counter({t: 2 * n for t, n in each.items()}) + Counter({b"": 2 * len(texts)})


def test_cut_texts_give_the_pairs_of_the_texts():
    vocabulary = lm.Vocabulary({b"": 9, b"a": 5, b"b": 4, b"  ": 3}, 2)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(ODD))), pa.array(ODD, pa.string()), pa.array([True] * len(ODD))], ["doc_id", "text", "teaches"]
    )
    (cut,) = lm._cut(SimpleNamespace(value=(vocabulary, 10, 3)))(iter([batch]))
    keys, of = lm._keys(cut, vocabulary.end, vocabulary.escape, len(vocabulary.counts))
    for i, text in enumerate(ODD):
        before, expected, rare = vocabulary.end, [], []
        for piece in lm.tokens_of(text):
            some, _, rare_here, before = vocabulary.pairs(piece, before)
            expected += some.tolist()
            rare += rare_here
        assert keys[of == i].tolist() == [*expected, before << lm.SHIFT | vocabulary.end]
        assert cut.column("rare")[i].as_py() == rare
        words = [t for piece in lm.tokens_of(text) for t in piece if not lm.BLANK.match(t)]
        assert cut.column("n_tokens")[i].as_py() == len(words) + 1


def test_tokens_with_the_same_path_make_one_choice():
    vocabulary = lm.Vocabulary({b"": 9, **{b"w%d" % i: 2 + i % 7 for i in range(500)}}, 40)
    leaves = len(vocabulary.counts)
    tokens = lm.Tokens(vocabulary, np.ones((lm.CLASSES, leaves), np.int64))
    keys = np.concatenate([np.arange(leaves) | c << lm.SHIFT for c in (3, 8)])
    tree = vocabulary.tree
    paths = {
        (k >> lm.SHIFT, d, int(tree.code[k & (1 << lm.SHIFT) - 1]) >> tree.deep - d - 1)
        for k in keys.tolist()
        for d in range(tree.length[k & (1 << lm.SHIFT) - 1])
    }
    made = sum(len(heads) for heads, *_ in tokens.steps(keys, np.ones(len(keys), np.int64), 0))
    assert made == len(paths) < tree.length.sum()


@pytest.mark.parametrize("gathered", [3, 1000])
def test_pairs_of_a_task_are_added_up(monkeypatch, gathered):
    monkeypatch.setattr(lm, "GATHERED", gathered)
    monkeypatch.setattr(lm, "SENT", 7)
    monkeypatch.setattr(lm, "ROWS", 4)
    draw = np.random.default_rng(6)
    keys, n = draw.integers(40, size=(30, 5)), draw.integers(1, 4, size=(30, 5))
    batches = [
        pa.RecordBatch.from_arrays([pa.array([[*map(int, k)]]), pa.array([[*map(int, m)]])], ["keys", "n"])
        for k, m in zip(keys, n, strict=True)
    ]
    taught: Counter = Counter()
    asked: Counter = Counter()
    for k, m in zip(keys.ravel().tolist(), n.ravel().tolist(), strict=True):
        taught[k >> 1] += m * (k & 1)
        asked[k >> 1] += m
    together = list(lm._together(iter(batches)))
    for only_taught in (False, True):
        rows = list(lm._rows(iter(together), only_taught))
        got = [x for b in rows for x in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert got == [(k, taught[k], asked[k]) for k in sorted(asked) if taught[k] or not only_taught]
        assert all(b.num_rows == 4 for b in rows[:-1])


def test_training_and_scoring_cut_texts_twice_and_agree(docs, spark, monkeypatch):
    """Once to count words, once into tokens; the same scores as by a model trained apart."""
    monkeypatch.setattr(lm, "PRICED", 500)
    monkeypatch.setattr(lm, "BUCKET", 1000)
    calls, real = [], lm.map_texts
    monkeypatch.setattr(lm, "map_texts", lambda *args: calls.append(args) or real(*args))
    rows = [(i, "Some  words come\n again %d" % (i % 9) + " more" * (i % 5) if i % 8 else None) for i in range(90)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    apart = F.col("doc_id") % 4 == 1
    got = lm.train_and_score(frame, apart).toPandas()
    assert len(calls) == 2
    model, words = lm.train(frame.where(~F.coalesce(apart, F.lit(True))))
    expected = lm.score(frame, model, words).toPandas()
    by = ["doc_id", "n_tokens", "score"]
    got, expected = (x.sort_values(by, ignore_index=True) for x in (got, expected))
    for column in ("n_tokens", "n_known", "train_tokens"):
        assert (got[column] == expected[column]).all()
    for column in ("base_score", "score", "bits_per_byte"):
        assert got[column].to_numpy() == pytest.approx(expected[column].to_numpy(), rel=1e-6)
