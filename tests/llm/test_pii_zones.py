from __future__ import annotations

import random

import numpy as np

from ofertario.llm import pii


def test_pii_learns_from_different_zones_and_every_kind(spark):
    texts = ["see 17 there"] * 4000 + [f"number {i} of the row" for i in range(3000)]
    texts += ["the token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" is", "write to ann@example.org today"]
    zones = pii.sample_zones(spark.createDataFrame([(t,) for t in texts], "text string").repartition(5))
    assert len(zones) == len(set(zones)) and len(zones) >= 120
    assert {k for z in zones for k, _, _ in pii.labelled(z)} == {"secret", "email"}


def test_the_field_finds_what_is_written_out(spark):
    """Written-out addresses and national numbers that no zone holds; plain numbers and words stay clean."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghiklmnoprstuvw") for _ in range(draw.randrange(2, 8)))
    number = lambda: f"+1 ({draw.randrange(200, 999)}) 555-{draw.randrange(1000, 9999)}"
    texts = [f"{word()} {word()} {draw.choice([number(), f'{word()}.{draw.randrange(99)}@{word()}.example.com'])} {word()}" for _ in range(300)]
    texts += [f"{word()} {draw.randrange(10**draw.randrange(1, 9))} {word()} {draw.randrange(99)}.{draw.randrange(99)}" for _ in range(300)]
    weights = pii.train(spark.createDataFrame([(t,) for t in texts], "text string").repartition(3))
    cases = {
        "write to name[at]example[dot]org now": "name[at]example[dot]org",
        "mail ann(at)example.org": "ann(at)example.org",
        "see first.last (at) mail (dot) example (dot) co (dot) uk please": "first.last (at) mail (dot) example (dot) co (dot) uk",
        "contact: joe [at] mail [dot] example [dot] com.": "joe [at] mail [dot] example [dot] com",
        "ann.lee[at]example[dot]org": "ann.lee[at]example[dot]org",
        "phone 415-555-2671": "415-555-2671",
        "reach (415) 555-2671 today": "(415) 555-2671",
    }
    found = {text: [text[a:b] for _, a, b in pii.find(text, weights)[1]] for text in cases}
    assert found == {text: [span] for text, span in cases.items()}
    for text in ["meet at 10 [at the gate] or later", "on 2024-05-17 we sold 1234567 items", "release 1.2 (dot) 4"]:
        assert pii.find(text, weights) == ([], [])


def test_the_best_segmentation_is_the_best_of_all():
    """Against all segmentations of short zones, with random weights."""
    draw = np.random.default_rng(3)
    for text in ["a 1-2 b", "x(at)y.z 7", "+4 (5) 6"]:
        zone, weights = pii.Zone(text, 0, len(text)), draw.normal(size=(pii.SIZE, len(pii.KINDS)))
        scores = weights[zone.rows].sum(axis=1).max(axis=1) - 0.5

        def most(at: int, zone=zone, scores=scores) -> float:
            if at >= len(zone.tokens):
                return 0.0
            taken = [scores[k] + most(j) for k, (i, j) in enumerate(zone.segments) if i == at]
            return max([most(at + 1), *taken])

        starts = {a: i for i, (a, _) in enumerate(zone.tokens)}
        ends = {b: i + 1 for i, (_, b) in enumerate(zone.tokens)}
        at = {s: k for k, s in enumerate(zone.segments)}
        got = zone.best(weights, [], 0.5)
        assert np.isclose(sum(scores[at[starts[a], ends[b]]] for _, a, b in got), most(0))
