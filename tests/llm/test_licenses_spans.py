from __future__ import annotations

import random

import pytest

from ofertario.llm import licenses

# Fixed value: the first paragraph and the disclaimer's beginning of the MIT license.
MIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
    "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
)


def labels(spark, texts, **options) -> dict:
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r.labels for r in licenses.label(frame, **options).collect()}


def test_repeated_words_behind_a_notice_lose_no_label(spark):
    """A list of versions chains diagonals; the notice before it stays."""
    tail = " 4.0" * 40
    got = labels(spark, ["licensed under CC BY NC 4.0" + tail, "licensed under CC BY NC 4.0", "4.0" + tail])
    assert got == {0: "cc-by,cc-by-nc-4.0", 1: "cc-by,cc-by-nc-4.0", 2: ""}


def test_templates_of_any_length(spark):
    """A whole license text is found, also with some words changed; its words at random are not."""
    draw = random.Random(1)
    words = MIT.split()
    assert len(words) > 64
    changed = [w if draw.random() > 0.05 else "other" for w in words]
    shuffled = draw.sample(words, len(words))
    texts = ["before " + MIT + " after", " ".join(changed), " ".join(shuffled), "a " * 500 + MIT]
    got = labels(spark, texts, notices=[(" ".join(MIT.lower().replace(",", " ").replace("(", " ").replace(")", " ").replace("/", " ").replace(".", " ").replace(":", " ").split()), "mit-text")])
    assert got == {0: "mit-text", 1: "mit-text", 2: "", 3: "mit-text"}


def brute_spans(words: list[str], template: list[str], k: int, slack: int, cover: float) -> bool:
    """Whether a notice is found, from every hit of every k-gram, merged by hand."""
    grams = [tuple(template[i : i + k]) for i in range(len(template) - k + 1)]
    diagonals: dict[int, list[tuple[int, int]]] = {}
    for at in range(len(words) - k + 1):
        for place, gram in enumerate(grams):
            if tuple(words[at : at + k]) == gram:
                diagonals.setdefault(at - place, []).append((at, place))
    groups: list[list[int]] = []
    for d in sorted(diagonals):
        if groups and d - groups[-1][-1] <= slack:
            groups[-1].append(d)
        else:
            groups.append([d])
    pieces = []
    for group in groups:
        hits = [h for d in group for h in diagonals[d]]
        wide = max(a for a, _ in hits) + k - min(a for a, _ in hits) > 2 * (len(grams) + k)
        pieces += [diagonals[d] for d in group] if wide else [hits]
    return any(len({p for _, p in hits}) / len(grams) >= cover for hits in pieces)


@pytest.mark.parametrize("seed", range(3))
def test_labels_equal_brute_force(spark, seed):
    """Texts of few words, notices with words changed, left out and put in."""
    draw = random.Random(seed)
    texts = []
    for _ in range(60):
        notice = draw.choice(licenses.NOTICES)[0].split()
        for _ in range(draw.randrange(4)):
            at = draw.randrange(len(notice))
            notice[at : at + draw.randrange(2)] = draw.choice([[], ["the"], ["license", "4"]])
            notice = notice or ["the"]
        around = [draw.choice("the license 4 0 under and of mit by cc".split()) for _ in range(draw.randrange(30))]
        texts.append(" ".join(around[: len(around) // 2] + notice + around[len(around) // 2 :]))
    got = labels(spark, texts)
    for i, text in enumerate(texts):
        words = text.split()
        expected = {label for phrase, label in licenses.NOTICES if brute_spans(words, phrase.split(), 2, 2, 0.75)}
        expected |= {label for phrase, label in licenses.BASE if f" {phrase} " in f" {text} "}
        assert set(filter(None, got[i].split(","))) == expected, text
