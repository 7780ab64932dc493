"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its documents in shuffled order, repeated up to
``max_repeats`` times. A copy's virtual finish time is the queue's cumulative
size up to and with the copy, divided by the source's target. Copies are served
in the order of finish times, over range buckets of that time, until the total
budget is used up; the copy that would exceed it and all later ones stay out, and so
do copies of which less than half fits into their source's target: else budget that
a very long document cannot use would go to the other sources beyond their targets.

Defined results: a null text has size 0, is served if its turn comes and takes
nothing; a null source is a source of its own, last by name; rows that repeat a
doc_id are documents of their own; an empty table gives an empty mix. Sources are
few against documents: one row for each meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ofertario.llm.common import buckets_for, hash_bucket, map_texts, only, sum_before
from ofertario.session import written

SIZES = "doc_id {id_type}, source {source_type}, row long, shuffle long, size long"


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size = [len(t.encode().split()) if t else 0 for t in batch.column("text").to_pylist()]
        names = ["doc_id", "source", "row", "shuffle"]
        columns = [*map(batch.column, names), pa.array(size, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, [*names, "size"])


def source_targets(
    sources: DataFrame, weights: list[float], share: float, max_repeats: int
) -> DataFrame:
    """source, source_size -> the same with source_no and target.

    Weights go round over the sources by name. The budget is ``share`` of all
    sizes. A target stops at ``max_repeats`` times its source's size; what is over
    goes to the others by weight. Filled like basins: sources in the order of
    cap / weight, the level being what is left over the weight that is left.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(by_name) - 1).alias("source_no")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    df = sources.select("source", "source_size", number)
    df = df.withColumn("__w", F.element_at(turn, (F.col("source_no") % len(weights) + 1).cast("int")))
    df = df.withColumn("__cap", F.col("source_size") * F.lit(float(max_repeats)))
    df = df.withColumn("__fill", F.col("__cap") / F.col("__w"))
    whole = Window.partitionBy()
    first = Window.orderBy("__fill", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    gone = lambda c: F.coalesce(F.sum(c).over(first), F.lit(0.0))
    budget = F.sum("source_size").over(whole) * F.lit(float(share))
    df = df.withColumn("__level", (budget - gone("__cap")) / (F.sum("__w").over(whole) - gone("__w")))
    level = F.max(F.when(F.col("__level") <= F.col("__fill"), F.col("__level"))).over(whole)
    df = df.withColumn("__level", level)
    target = F.when(F.col("__level") * F.col("__w") < F.col("__cap"), F.col("__level") * F.col("__w"))
    return df.select(
        "source_no", "source", "source_size", F.coalesce(target, F.col("__cap")).alias("target")
    )


def plan(
    docs: DataFrame,
    weights: list[float],
    share: float = 1.5,
    max_repeats: int = 2,
    seed: int = 17,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken,
    finish (the first copy's virtual finish time) and row: the document's place in the
    input, or its unique number in ``row_col``."""
    row = docs[f"`{row_col}`"] if row_col else F.monotonically_increasing_id()
    cols = only(docs.withColumn("__row", row), doc_id=id_col, source=source_col, text=text_col, row="__row")
    # By id and text, so that rows of one id, or of none, are not one place in the shuffle.
    cols = cols.withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "text"))
    kinds = {f.name: f.dataType.simpleString() for f in cols.schema.fields}
    schema = SIZES.format(id_type=kinds["doc_id"], source_type=kinds["source"])
    sized = written(map_texts(cols, _sizes, schema), "sizes")
    sources = written(
        source_targets(
            sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeats
        ),
        "sources",
    )
    facts = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts, budget = buckets_for(facts[0]), float(facts[1]) * share
    queued = sized.join(
        sources.withColumnRenamed("source", "__source"),
        F.col("source").eqNullSafe(F.col("__source")),
    ).drop("__source")
    queued = written(queued.withColumn("part", hash_bucket(F.col("shuffle"), parts)), "queues")
    queued = written(
        sum_before(queued, ["source_no"], "part", ["shuffle", "doc_id", "row"], "size", "ahead"),
        "served",
    )

    def finish(copy):
        return F.coalesce(
            (copy * F.col("source_size") + F.col("ahead") + F.col("size")) / F.nullif("target", F.lit(0.0)),
            F.lit(0.0),
        )

    def fits(copy):
        return copy * F.col("source_size") + F.col("ahead") + F.col("size") / 2 <= F.col("target")

    def ticket(copy):
        """The order in which copies are served."""
        return F.struct(
            finish(copy).alias("finish"), copy.alias("copy"), F.col("shuffle"), F.col("row")
        )

    copies = queued.select(
        F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))).alias("copy"), *queued.columns
    )
    copies = copies.where(fits(F.col("copy"))).select("size", ticket(F.col("copy")).alias("ticket"))
    # Times from 0 to infinity over range buckets; the budget ends in one of them.
    time = F.col("ticket.finish")
    copies = copies.withColumn("part", F.floor(time / (1 + time) * parts).cast("long"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    sums = copies.groupBy("part").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("upto", F.sum("size").over(so_far))
    over = sums.where(F.col("upto") > budget).orderBy("part").limit(1).collect()
    if over:
        part, start = over[0]["part"], over[0]["upto"] - over[0]["size"]
        inside = Window.partitionBy("part").orderBy("ticket")
        last = (
            copies.where(F.col("part") == part)
            .withColumn("upto", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) + start)
            .where(F.col("upto") > budget)
            .agg(F.min("ticket").alias("ticket"))
            .first()["ticket"]
        )
        end = F.struct(
            F.lit(last["finish"]).alias("finish"),
            F.lit(last["copy"]).alias("copy"),
            F.lit(last["shuffle"]).cast("long").alias("shuffle"),
            F.lit(last["row"]).cast("long").alias("row"),
        )
        served = [(fits(F.lit(c)) & (ticket(F.lit(c)) < end)).cast("int") for c in range(max_repeats)]
    else:
        served = [fits(F.lit(c)).cast("int") for c in range(max_repeats)]
    return queued.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        sum(served[1:], served[0]).alias("copies"),
        finish(F.lit(0)).alias("finish"),
        "row",
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame, weights: list[float], id_col: str = "doc_id", **options) -> DataFrame:
    """The documents of the mix with all their columns, repeated as often as they
    are taken and range-sorted by virtual finish time. Rows are written with a number
    that ties them to the plan, so null and repeated ids are documents of their own."""
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    planned = plan(numbered, weights, id_col=id_col, row_col="__row", **options).where("copies > 0")
    turns = written(
        planned.select(F.col("row").alias("__id"), "copies", "finish", "source_size", "target"), "turns"
    )
    step = F.coalesce(F.col("source_size") / F.nullif("target", F.lit(0.0)), F.lit(0.0))
    joined = numbered.join(
        turns.select(
            "__id", F.col("copies").alias("__copies"), F.col("finish").alias("__finish"), step.alias("__step")
        ),
        numbered["__row"] == F.col("__id"),
    )
    repeated = joined.select(
        F.explode(F.sequence(F.lit(0), F.col("__copies") - 1)).alias("__copy"), *[f"`{c}`" for c in joined.columns]
    )
    served = (F.col("__finish") + F.col("__copy") * F.col("__step")).alias("__served")
    return (
        repeated.select(served, "__row", *[repeated[f"`{c}`"] for c in docs.columns])
        .orderBy("__served", f"`{id_col}`", "__row")
        .drop("__served", "__row")
    )
