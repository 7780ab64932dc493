from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ofertario.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<double>"


def brute(rows: list, asked: set, scale: int = 256) -> list:
    """Every pair's integer score, whole and sorted."""
    usable = [
        (i, vec, label, [math.floor(scale * x) for x in v])
        for i, (vec, label, v) in enumerate(rows)
        if vec is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for i, anchor, label, v in usable:
        if anchor not in asked:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(v, w, strict=True)), vec, other)
            for j, vec, other, w in usable
            if j != i and len(w) == len(v)
        )
        for ps, positive, _ in [s for s in scored if s[2] == label][:5]:
            worse = [(-ns, n) for ns, n, other in scored if other != label and 50 * -ps <= 100 * -ns <= 95 * -ps]
            out += [(anchor, positive, k, n, -ps, ns) for k, (ns, n) in enumerate(worse[:3], 1)]
    return sorted(out)


def got(frame) -> list:
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in frame.select(*names).collect())


def ids(spark, asked):
    return spark.createDataFrame([(a,) for a in sorted(asked)], "anchor_id long")


@pytest.mark.parametrize("shape", ["spread", "clustered", "coarse"])
def test_mining_equals_brute_force(spark, shape):
    """Also clusters that windows tell apart, and few different values with many ties."""
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(6, 12)) * 3
    rows = []
    for i in range(500):
        v = draw.normal(size=12) + (centres[i % 6] if shape == "clustered" else 0)
        v = np.round(v) if shape == "coarse" else v * draw.choice([0.1, 1, 4])
        rows.append((i, int(draw.integers(0, 4)) if i % 3 else i % 6, v.tolist()))
    asked = set(range(0, 500, 25))
    frame = spark.createDataFrame(rows, SCHEMA)
    found = got(negatives.mine(frame, ids(spark, asked), window=16, chunk=64, group=6))
    expected = brute(rows, asked)
    assert found == expected and len(expected) > 50


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, i % 3, [float((i * k) % 7 - 2) for k in (1, 2, 3)]) for i in range(60)]
    rows += [
        (100, None, [1.0, 2.0, 3.0]),
        (101, 1, None),
        (102, 1, [1.0, None, 2.0]),
        (103, 1, [nan, 1.0, 2.0]),
        (104, 1, [inf, 1.0, 2.0]),
        (None, 1, [5.0, 1.0, 2.0]),
        (105, 1, []),
        (106, 2, []),
        (107, 1, [0.0, 0.0, 0.0]),
        (108, 1, [1.0, 2.0]),
        (109, 2, [1.0, 1.5]),
        (110, 1, [1.0, 1.75]),
        (7, 1, [2.0, 2.0, 2.0]),
        (8, 2, [2.0, 2.0, 1.0]),
        (8, 2, [2.0, 2.0, 1.0]),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "chunk", "norm", "angles", "group", "a.b"):
        frame = frame.withColumn(name, F.lit("own"))
    asked = {0, 7, 8, 33, 100, 103, 105, 107, 108, 999}
    assert got(negatives.mine(frame, ids(spark, asked))) == brute(rows, asked)
    assert got(negatives.mine(frame.where("false"), ids(spark, asked))) == []


def test_scores_beyond_doubles_stay_exact(spark):
    draw = np.random.default_rng(2)
    rows = [(i, i % 2, (draw.integers(0, 2**20, 4) * 4.0 + i / 256).tolist()) for i in range(40)]
    asked = {0, 5, 10}
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(negatives.mine(frame, ids(spark, asked), window=8)) == brute(rows, asked)


def test_intervals_hold_and_pass_windows_over():
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(8, 16)) * 5
    rows = np.floor(np.repeat(centres, 50, axis=0) * 20 + draw.normal(size=(400, 16)) * 8)
    refs = negatives.directions(rows, 8)
    norms = np.linalg.norm(rows, axis=1)
    angles = np.arccos(np.clip(rows @ refs.T / norms[:, None], -1, 1))
    apart = 0
    for start in range(0, 400, 50):
        window = slice(start, start + 50)
        low, high = negatives.interval(norms, angles, angles[window], norms[window])
        s = rows @ rows[window].T
        assert (s >= low[:, None]).all() and (s <= high[:, None]).all()
        apart += int((high < np.sort(rows @ rows.T, axis=1)[:, -6]).sum())
    assert apart > 400
