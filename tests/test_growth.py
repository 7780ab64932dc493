"""What a query costs must not grow faster than its input."""

from __future__ import annotations

import datetime as dt
import hashlib
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from contract import order_offers, queries
from ofertario.operators import issuers, mapping
from ofertario.session import scratch
from ofertario.sources import landing


def _best_seconds(df) -> float:
    found = []
    for _ in range(3):
        begun = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        found.append(time.perf_counter() - begun)
    return min(found)


def test_plain_key_looks_up_odd_characters_only(spark):
    texts = [("plain", "caña fina " * 20_000), ("odd", "½" + "caña fina " * 20_000)]
    rows = spark.createDataFrame(texts * 4, "kind string, text string").coalesce(1).localCheckpoint()
    keys = rows.select("kind", issuers.plain_key("text").alias("key"))
    assert {(r.kind, r.key) for r in keys.collect()} == {
        ("plain", "canafina" * 20_000),
        ("odd", "12" + "canafina" * 20_000),
    }
    simple = rows.select(F.translate(F.lower("text"), "ñ", "n"))
    assert _best_seconds(keys) < 12 * _best_seconds(simple)


def _text(entries):
    return F.array_join(F.transform(entries, lambda e: F.coalesce(e["v"], F.lit("?"))), ",")


@pytest.mark.parametrize("size", [40, 4000])
def test_shown_is_made_once_for_each_key(spark, size):
    dim = spark.range(size).select((F.col("id") % 10).alias("k"), F.concat(F.lit("v"), "id").alias("v"))
    rows = spark.createDataFrame([(1, 3, [3, 77]), (2, None, None), (3, 99, []), (4, 3, [None, 4])], "id int, k int, ks array<int>")
    folders: list[str] = []
    with scratch(folders):
        value = mapping.map_value(rows, "m", [F.col("k")], dim, ["k"], ["v"], ["v"], shown=_text)
        elements = mapping.map_elements(rows, "m", "ks", lambda k: [k], dim, ["k"], ["v"], ["v"], shown=_text)
    of_value = mapping.map_value(rows, "m", [F.col("k")], dim, ["k"], ["v"], ["v"]).withColumn("m", _text("m"))
    of_elements = mapping.map_elements(rows, "m", "ks", lambda k: [k], dim, ["k"], ["v"], ["v"]).withColumn("m", _text("m"))
    for got, expected in ((value, of_value), (elements, of_elements)):
        assert got.columns == expected.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    kept = [spark.read.parquet(f).schema.simpleString() for f in folders]
    assert sum("struct<shown:string>" in schema for schema in kept) == (2 if size > mapping.INLINE_ROWS else 0)


def _long_texts(spark, kind):
    """Long texts mapped to rows, half of them of one key and a quarter of none; the texts by key."""
    parts = [F.sha2(F.concat_ws("-", "id", F.lit(i)), 512) for i in range(5)]
    dim = spark.range(4000).select((F.col("id") % 40).alias("k"), F.concat(*parts).alias("v"))
    place = F.floor(F.col("id") / 4) % 41
    key = F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 4 == 1, F.when(place < 40, place).otherwise(99))
    rows = spark.range(0, 4000, 1, 8).select("id", key.alias("k"))
    texts = {r.k: r.t for r in dim.groupBy("k").agg(_text(F.array_sort(F.collect_list(F.struct("v")))).alias("t")).collect()}
    if kind == "value":
        return rows, mapping.map_value(rows, "m", [F.col("k")], dim, ["k"], ["v"], ["v"], shown=_text), texts | {None: "", 99: ""}
    arrays = rows.withColumn("ks", F.when(F.col("k").isNotNull(), F.array("k")))
    mapped = mapping.map_elements(arrays, "m", "ks", lambda k: [k], dim, ["k"], ["v"], ["v"], shown=_text)
    return rows, mapped.drop("ks"), texts | {None: None, 99: "?"}


@pytest.mark.parametrize("kind", ["value", "elements"])
def test_files_hold_a_long_text_once(spark, tmp_path, kind):
    rows, mapped, texts = _long_texts(spark, kind)
    mapped.write.parquet(f"{tmp_path}/out")
    size = sum(f.stat().st_size for f in (tmp_path / "out").glob("*.parquet"))
    assert size < 2 * sum(len(t or "") for t in texts.values())
    found = spark.read.parquet(f"{tmp_path}/out")
    assert found.columns == ["id", "k", "m"]
    read = found.select("id", "k", F.md5("m").alias("m"), F.input_file_name().alias("file")).collect()
    md5 = {k: None if t is None else hashlib.md5(t.encode()).hexdigest() for k, t in texts.items()}
    assert sorted((r.id, r.m) for r in read) == sorted((r.id, md5[r.k]) for r in rows.collect())
    for key in (0, None):
        assert len({r.file for r in read if r.k == key}) > 1


@pytest.fixture
def orders(spark, tmp_path):
    """Orders of three months in 16 files, with their customers."""
    day = F.date_add(F.lit(dt.date(2000, 1, 1)), (F.col("id") % 90).cast("int"))
    facts = spark.range(0, 480, 1, 16).select(
        F.col("id").alias("o_orderkey"),
        (F.col("id") % 50).alias("o_custkey"),
        F.lit("F").alias("o_orderstatus"),
        day.alias("o_orderdate"),
        F.lit("2-HIGH").alias("o_orderpriority"),
    )
    facts.write.parquet(f"{tmp_path}/orders.parquet")
    customers = "id AS c_custkey", "'FURNITURE' AS c_mktsegment", "1L AS c_nationkey"
    spark.range(50).selectExpr(*customers).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1, 2).selectExpr("id AS n_nationkey", "1L AS n_regionkey").write.parquet(f"{tmp_path}/nation.parquet")
    spark.range(1, 2).selectExpr("id AS r_regionkey", "'ASIA' AS r_name").write.parquet(f"{tmp_path}/region.parquet")
    return str(tmp_path)


def _files(path: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for file in Path(path).glob("spider=*/scraped_at_dt=*/part-*"):
        found[str(file.parent)] = found.get(str(file.parent), 0) + 1
    return found


def test_landed_files_follow_folders_not_tasks(spark, orders):
    files = _files(queries._landed(spark, orders))
    assert len(files) == 9 and sum(files.values()) <= 12
    rows = queries._raw(spark, orders)
    assert rows.count() == 480
    text = F.to_json("raw_payload")
    own = order_offers.rendered_orders(spark, orders).select(text, "spider", "scraped_at_dt")
    assert rows.select(text, "spider", "scraped_at_dt").exceptAll(own).isEmpty()


def test_one_file_a_folder_by_several_tasks(spark, orders, tmp_path):
    rows = order_offers.rendered_orders(spark, orders)
    before = spark.conf.get(landing._OPEN_FILES)
    landing.write_landing(rows, f"{tmp_path}/one", files_per_folder=1)
    landing.write_landing(rows, f"{tmp_path}/any")
    assert spark.conf.get(landing._OPEN_FILES) == before
    assert list(_files(f"{tmp_path}/one").values()) == [1] * 9
    one, any_ = (spark.read.text(f"{tmp_path}/{name}") for name in ("one", "any"))
    assert one.exceptAll(any_).isEmpty() and one.count() == any_.count() == 480


def test_whole_folders_are_one_file_each(spark, orders, tmp_path):
    landing.write_landing(order_offers.orders_by_folder(spark, orders, whole=True), f"{tmp_path}/whole")
    assert list(_files(f"{tmp_path}/whole").values()) == [1] * 9
    counts = [r["new_files"] for r in queries.s5_file_ledger(spark, orders).collect()]
    assert counts == [1] * 18


def test_arrivals_are_made_by_several_tasks(spark, orders):
    group, tracker = uuid.uuid4().hex, spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(group, "arrivals")
    try:
        counts = [r["new_files"] for r in queries.s5_new_files(spark, orders).collect()]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts == [2] * 3
    jobs = filter(None, map(tracker.getJobInfo, tracker.getJobIdsForGroup(group)))
    stages = filter(None, (tracker.getStageInfo(s) for job in jobs for s in job.stageIds))
    assert max(s.numTasks for s in stages if s.numCompletedTasks) >= 8
