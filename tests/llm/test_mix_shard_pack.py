from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings, strategies as st

from ofertario.llm import mixing, packing, sharding

from llm_helpers import text_of, words_of

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def test_mix_comes_near_its_targets(docs, rows):
    got = mixing.plan(docs, [3, 1, 2]).toPandas()
    rows = rows.assign(size=[len(words_of(t)) for t in rows.text], source=rows.source.map(lambda s: s or ""))
    assert sorted(got["size"]) == sorted(rows["size"])
    sizes = rows.groupby("source")["size"].sum()
    names = sorted(n for n in sizes.index if n) + [""]
    weights = {n: [3, 1, 2][i % 3] for i, n in enumerate(names)}
    budget, target = 1.5 * sizes.sum(), {}
    while True:
        left = [n for n in names if n not in target]
        level = (budget - sum(target.values())) / sum(weights[n] for n in left)
        over = [n for n in left if level * weights[n] > 2 * sizes[n]]
        target |= {n: 2.0 * sizes[n] for n in over}
        if not over:
            target |= {n: level * weights[n] for n in left}
            break
    got["source"] = got.source.map(lambda s: s or "")
    for name, of in got.groupby("source"):
        assert of.target.iloc[0] == pytest.approx(target[name])
        assert of.source_size.iloc[0] == sizes[name]
        assert abs(of.taken.sum() - target[name]) <= of["size"].max()
    assert (got.taken <= 2 * got["size"]).all() and got.taken.sum() <= budget


def test_mix_reruns_agree(docs):
    first, second = ({(r.doc_id, r.taken) for r in mixing.plan(docs, [3, 1, 2]).collect()} for _ in range(2))
    assert first == second


def test_mixed_rows_repeat_in_their_order(docs):
    unique = docs.where("doc_id < 9008")
    plan = {r.doc_id: r.copies for r in mixing.plan(unique, [3, 1, 2]).collect()}
    mixed = mixing.mix(unique, [3, 1, 2])
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == {d: n for d, n in plan.items() if n}


def test_mix_of_nothing(empty):
    assert mixing.plan(empty, [3, 1, 2]).count() == 0


def test_shards_are_even_and_gapless(docs, rows):
    got = sharding.shard(docs, 4).toPandas()
    raw = [text_of(t).encode() for t in rows.text]
    expected = Counter((len(b) + 1, len(b.split()), zlib.crc32(b)) for b in raw)
    assert Counter(zip(got["size"], got.words, got.text_crc32, strict=True)) == expected
    for _, of in got.groupby("shard"):
        assert sorted(of.slot) == list(range(len(of)))
    share = got.groupby("shard")["size"].sum() / got["size"].sum()
    assert len(share) == 4 and share.max() < 0.3


def test_equal_texts_share_a_shard_unless_hot(spark):
    rows = [(i, f"text {i % 400} " * 9) for i in range(2000)] + [(10_000 + i, "hot") for i in range(2000)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 8).toPandas()
    shards = got.groupby("text_crc32").shard.nunique()
    assert (shards.drop(zlib.crc32(b"hot")) == 1).all() and shards[zlib.crc32(b"hot")] > 1
    for column in ("size", "words"):
        of = got.groupby("shard")[column].sum()
        assert of.max() < 1.03 * of.mean()
    assert got.groupby("shard").slot.count().max() < 1.03 * len(got) / 8


def test_shards_of_nothing(empty):
    assert sharding.shard(empty).count() == 0


def slow_best_fit(lengths: list[int], window: int) -> list[int]:
    """Fills of the windows, one piece after the other."""
    left: list[int] = []
    for length in sorted(lengths, reverse=True):
        fits = [c for c in left if c >= length]
        if fits:
            left[left.index(min(fits))] -= length
        else:
            left.append(window - length)
    return sorted(left)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
def test_best_fit_in_bulk_equals_one_by_one(lengths, window):
    runs = packing.best_fit(dict(Counter(lengths)), window)
    windows: dict[int, list[tuple[int, int]]] = {}
    for length, _, n, each, first, offset in runs:
        for nth in range(n):
            windows.setdefault(first + nth // each, []).append((offset + nth % each * length, length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(windows) == list(range(len(windows)))
    assert sorted(window - sum(n for _, n in p) for p in windows.values()) == slow_best_fit(lengths, window)


def test_pack_holds_every_token_once(docs, rows):
    got = packing.pack(docs, TOKENIZER).toPandas()
    whole = tokenizers.Tokenizer.from_file(TOKENIZER)
    expected = Counter()
    for text in rows.text:
        ids = np.array([*whole.encode(text_of(text), add_special_tokens=False).ids, 2], "<u4").tobytes()
        for start in range(0, len(ids) // 4, 4096):
            expected[(start, len(ids) // 4, ids[4 * start : 4 * (start + 4096)])] += 1
    assert Counter(zip(got.start, got.doc_tokens, map(bytes, got.ids), strict=True)) == expected
    assert (got.ids_crc32 == got.ids.map(zlib.crc32)).all() and (got.length * 4 == got.ids.map(len)).all()
    got = got.sort_values(["sequence_id", "offset"])
    before = got.groupby("sequence_id").length.cumsum() - got.length
    assert (before == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 4096
    assert got.sequence_id.max() + 1 == got.sequence_id.nunique()


@pytest.mark.parametrize(
    "text",
    ["It's   we'll 'S x'Sy", "ÀÉÎ ΑΣ ΣΑΣ ß İI", "éa ́b", "<|endoftext|> <|x", "a\x0bb\x0cc\x1cd e　f",
     "１２３ ½ x² 中文字 🙂👍🏽", "_under_score__ a_b", "\x7f\x00 a​b ﬁ", "don't'll'", "ǅ ŉ Ⅷ ª"],
)
def test_ids_are_those_of_the_tokenizer(text):
    whole = tokenizers.Tokenizer.from_file(TOKENIZER)
    ids = whole.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(packing.encoder(TOKENIZER)(text), "<u4").tolist() == ids


def test_pack_of_nothing(empty):
    assert packing.pack(empty, TOKENIZER).count() == 0
