from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ofertario.llm import exact_dedup, jaccard
from ofertario.llm.components import components
from ofertario.session import fresh_folder, shared_folder

from llm_helpers import text_of


def test_exact_dedup_report(docs, rows, spark):
    got = exact_dedup.dedup(docs, exact_dedup.new_index(spark)).toPandas()
    assert len(got) == len(rows)
    groups = rows.assign(text=rows.text.map(text_of)).groupby("text").doc_id
    expected = {hashlib.sha256(t.encode()).digest(): (-1 if pd.isna(g.max()) else g.max(), len(g)) for t, g in groups}
    for r in got.fillna({"keep_id": -1}).itertuples():
        assert (r.keep_id, r.group_size) == expected[bytes(r.digest)]
    assert Counter(bytes(d) for d in got[got.kept].digest) == dict.fromkeys(expected, 1)


def test_kept_rows_are_one_of_each_text(docs, rows, spark):
    kept = exact_dedup.kept_rows(docs, exact_dedup.new_index(spark))
    assert kept.columns == docs.columns
    got = kept.toPandas()
    assert sorted(got.text.map(text_of)) == sorted(set(rows.text.map(text_of)))
    assert 9009 in set(got.doc_id) and 9008 not in set(got.doc_id)
    assert set(got.row) == {"own"}


def test_the_index_outlives_a_session(docs, spark):
    path = fresh_folder(spark, "index")
    exact_dedup.dedup(docs, exact_dedup.DigestIndex(spark, path, 4))
    again = exact_dedup.DigestIndex(spark, path, 4)
    before = again.read().count()
    new = docs.where("doc_id < 9").unionByName(docs.limit(1).withColumn("text", F.lit("unseen")))
    told = exact_dedup.dedup(new, again).toPandas()
    assert told.known.sum() == len(told) - 1
    assert told[~told.known].kept.all() and not told[told.known].kept.any()
    assert again.read().count() == before + 1


def test_exact_dedup_of_nothing(empty, spark):
    assert exact_dedup.kept_rows(empty, exact_dedup.new_index(spark)).count() == 0


def brute_components(texts: dict, words: int, percent: int) -> tuple[dict, dict]:
    sets, parent = {}, {d: d for d in texts}
    for d, t in texts.items():
        w = t.encode().lower().split()
        sets[d] = {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in sets}, {d: len(s) for d, s in sets.items()}


def altered(base: list[str], changes: int, draw: random.Random) -> str:
    words = list(base)
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
    return " ".join(words)


CASES = [(3, 90, 1 << 22, 0), (5, 80, 1 << 22, 0), (3, 90, 2000, 0), (5, 80, 2000, 0), (5, 80, 1 << 22, 12), (3, 90, 2000, 3)]


@pytest.mark.parametrize(("words", "percent", "task", "spare"), CASES)
def test_jaccard_components(spark, words, percent, task, spare):
    """Groups from tight to chained, shared passages; also with groups too large for a task."""
    draw = random.Random(words)
    texts: dict[int, str] = {}
    passage = [f"p{i}" for i in range(60)]
    for group in range(6):
        base = [f"g{group}x{draw.randrange(400)}" for _ in range(draw.choice([4, 12, 60, 150]))]
        for _ in range(25):
            base = altered(base, 1, draw).split() if group % 2 else base
            texts[draw.randrange(10**6)] = altered(base, draw.randrange(4), draw)
    for _ in range(40):
        own = [f"o{draw.randrange(10**5)}" for _ in range(draw.choice([5, 20, 80]))]
        texts[draw.randrange(10**6)] = " ".join(own + passage)
    texts |= {10**6 + i: t for i, t in enumerate(["", "  ", "one", "ONE", "one two", "a b c", "a b c"])}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = jaccard.link(frame, words=words, percent=percent, task_shingles=task, spare=spare).toPandas()
    components_of, sizes = brute_components(texts, words, percent)
    assert dict(zip(got.doc_id, got.component_id, strict=True)) == components_of
    assert dict(zip(got.doc_id, got.n_shingles, strict=True)) == sizes


@pytest.mark.parametrize(("percent", "spare"), [(90, 0), (80, 0), (80, 12), (70, 5)])
def test_linked_sets_have_a_fragment_in_common(percent, spare):
    """Sets as far apart as may be share more fragments than are spared, in one band."""
    draw = random.Random(percent)
    for size in [*range(2, 60), 100, 149, 151, 400, 900]:
        for _ in range(12):
            fragments = jaccard.Fragments(percent, spare)
            whole = [draw.getrandbits(64) for _ in range(2 * size)]
            a = set(whole[:size])
            gone = draw.randrange(size * (100 - percent) // 100 + 1)
            b = set(whole[gone:size])
            new = 0
            while 100 * len(a & b) >= percent * len(a | b | set(whole[size : size + new + 1])):
                new += 1
            b |= set(whole[size : size + draw.randrange(new)] if new else [])
            if a == b or 100 * len(a & b) < percent * len(a | b):
                continue
            keys = [fragments.of(np.array(sorted(s), np.uint64)) for s in (a, b)]
            shared = max(
                (len(set(x) & set(y)) - spared for x, spared in keys[0] for y, _ in keys[1] if set(x) & set(y)),
                default=0,
            )
            assert shared > 0


def test_jaccard_on_edge_cases(docs, rows):
    got = jaccard.link(docs).toPandas()
    assert len(got) == len(rows)
    with_id = rows[rows.doc_id.notna()].drop_duplicates("doc_id")
    expected, sizes = brute_components({int(d): text_of(t) for d, t in zip(with_id.doc_id, with_id.text, strict=True)}, 3, 90)
    found = got[got.doc_id.notna()].drop_duplicates("doc_id")
    assert {int(d): int(c) for d, c in zip(found.doc_id, found.component_id, strict=True)} == expected
    assert {int(d): n for d, n in zip(found.doc_id, found.n_shingles, strict=True)} == sizes
    assert got[got.doc_id.isna()].component_id.isna().all()


def test_one_of_each(docs):
    kept = jaccard.one_of_each(docs, words=5, percent=80)
    assert kept.columns == docs.columns
    assert {9002, 9004, 9007}.issubset({r.doc_id for r in kept.select("doc_id").collect()})
    assert kept.where("doc_id = 9009").isEmpty()


def test_a_text_goes_by_its_own_links(spark):
    """Rows that share an id with a copy stay; null ids take no part; repeated rows are one."""
    base = " ".join(f"w{i}" for i in range(60))
    other, third = " ".join(f"o{i}" for i in range(30)), "x y z x y w"
    rows = [(3, base, 1), (7, base + " end", 2), (7, other, 3), (9, third, 4), (9, third, 5), (None, base, 6)]
    rows += [(None, other, 7), (5, None, 8), (5, "", 9), (8, base + " end", 10), (3, third + " v", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int")
    kept = sorted(r.mark for r in jaccard.one_of_each(docs, words=5, percent=80, spare=12).collect())
    assert kept[:4] == [1, 3, 4, 6] or kept[:4] == [1, 3, 5, 6]
    assert kept[4:] == [7, 8, 9, 11]
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0) for r in jaccard.link(docs, words=5, percent=80).collect())
    assert got == sorted(
        [(3, 56, 3), (7, 57, 3), (7, 26, 7), (9, 2, 9), (9, 2, 9), (0, 56, 0), (0, 26, 0), (5, 0, 5), (5, 0, 5), (8, 57, 3), (3, 3, 3)]
    )


def test_intermediates_are_removed(spark, docs):
    folder = Path(shared_folder(spark))
    before = set(folder.iterdir())
    assert jaccard.link(docs).count() > 0
    assert len(set(folder.iterdir()) - before) == 1


def test_jaccard_of_nothing(empty):
    assert jaccard.link(empty).count() == 0


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 999), (5, 5)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {999: 999, 1000: 999}
