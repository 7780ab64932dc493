"""Connected components of an edge table, by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ofertario.session import written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); the component is its smallest id.

    Each round takes the smallest label among neighbours and then that label's own
    label, so that paths shrink by halves. Labels are written in every round.
    """
    both = edges.where("a <> b").select("a", "b")
    both = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels"
    )
    for _ in range(rounds):
        old = labels
        of_next = old.select(F.col("id").alias("b"), F.col("component").alias("near"))
        near = both.join(of_next, "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        lower = written(
            old.join(near, "id").select("id", "component", F.least("component", "near").alias("lower")), "lower"
        )
        jump = lower.select(F.col("id").alias("lower"), F.col("lower").alias("jumped"))
        labels = written(
            lower.join(jump, "lower", "left").select(
                "id", "component", F.least("lower", F.coalesce("jumped", "lower")).alias("new")
            ),
            "labels",
        )
        changed = labels.where("new <> component").isEmpty()
        labels = labels.select("id", F.col("new").alias("component"))
        if changed:
            return labels
    raise RuntimeError(f"no fixed point in {rounds} rounds")
