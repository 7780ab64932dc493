from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest
from payloads import BBVA, NARANJAX, changed
from pyspark.sql import functions as F
from test_streaming import land, plain

from ofertario.operators import merge, uniqueness
from ofertario.plans import build as plan
from ofertario.sources import keyed, landing
from ofertario.streaming import fact_stream, landing_stream

SCHEMA = "id long, value string"


def files(path) -> dict[str, set[str]]:
    """The parquet files of each bucket folder."""
    found: dict[str, set[str]] = {}
    for file in Path(path).rglob("*.parquet"):
        found.setdefault(file.parent.name, set()).add(file.name)
    return found


def test_an_increment_rewrites_the_buckets_of_its_ids(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = spark.createDataFrame([(i, "old") for i in range(200)] + [(None, "none")], SCHEMA)
    keyed.upsert_keyed(rows, path, "id", 8)
    before = files(path)
    assert len(before) == 8
    one = rows.where(keyed.bucket_of("id", 8) == 3).withColumn("value", F.lit("new"))
    assert keyed.upsert_keyed(one, path, "id", 8) == [3]
    after = files(path)
    assert [b for b in before if before[b] != after[b]] == ["bucket_of_8=3"]
    expected = merge.upsert(rows, one)
    assert plain(keyed.read_keyed(spark, path, rows.schema, 8)) == plain(expected)
    assert keyed.upsert_keyed(rows.where("false"), path, "id", 8) == []


def test_an_emptied_bucket_goes(spark, tmp_path):
    path = str(tmp_path / "keyed")
    rows = spark.createDataFrame([(i, "old") for i in range(50)], SCHEMA)
    keyed.upsert_keyed(rows, path, "id", 4)
    keyed.replace_buckets(rows.where("false"), path, "id", 4, [2])
    kept = rows.where(keyed.bucket_of("id", 4) != 2)
    assert plain(keyed.read_keyed(spark, path, rows.schema, 4)) == plain(kept)
    assert keyed.read_keyed(spark, str(tmp_path / "none"), rows.schema, 4).count() == 0


def run(spark, tmp_path, **options):
    stream = landing_stream.read_landing_stream(spark, str(tmp_path / "zone"), **options)
    query = fact_stream.start_fact_stream(stream, str(tmp_path / "tables"), str(tmp_path / "checkpoint"), buckets=8)
    query.awaitTermination()
    return fact_stream.read_fact(spark, str(tmp_path / "tables"))


def batch_fact(spark, tmp_path):
    raw = landing.read_landing(spark, str(tmp_path / "zone"), spider=["bbva", "naranjax"])
    return merge.fact_columns(plan.offers(raw))


def test_three_batches_give_the_batch_fact(spark, tmp_path):
    """New, changed, late and equal offers; a batch of nothing new; a single change."""
    zone, tables = tmp_path / "zone", tmp_path / "tables"
    shops = [changed(BBVA, source_id=i, cabecera=f"Shop {i % 6}") for i in range(12)]
    land(zone, "bbva", "2025-06-01", "a.jsonl", *shops)
    land(zone, "naranjax", "2025-06-01", "a.jsonl", NARANJAX)
    assert plain(run(spark, tmp_path)) == plain(batch_fact(spark, tmp_path))
    # Id 1 leaves its content for that of 2 and 8, id 7 keeps what 1 had; 3 arrives late.
    land(zone, "bbva", "2025-06-08", "a.jsonl", changed(BBVA, source_id=1, cabecera="Shop 2"))
    land(zone, "bbva", "2025-05-25", "a.jsonl", changed(BBVA, source_id=3, cabecera="Late"))
    assert plain(run(spark, tmp_path)) == plain(batch_fact(spark, tmp_path))
    # Both of a content leave it; its row goes.
    gone = [changed(BBVA, source_id=i, cabecera="Moved") for i in (4, 10)]
    land(zone, "bbva", "2025-06-09", "a.jsonl", *gone)
    third = run(spark, tmp_path)
    assert plain(third) == plain(batch_fact(spark, tmp_path))
    assert "Shop 4" not in {r.merchant_name for r in third.collect()}
    before = {name: files(tables / name) for name in ("ids", "members", "fact")}
    land(zone, "bbva", "2025-06-10", "a.jsonl", changed(BBVA, source_id=5, cabecera="Alone"))
    assert plain(run(spark, tmp_path)) == plain(batch_fact(spark, tmp_path))
    touched = {}
    for name, old in before.items():
        new = files(tables / name)
        touched[name] = sum(old.get(b) != new.get(b) for b in old.keys() | new.keys())
    # One id; its old and new content.
    assert touched["ids"] == 1 and touched["members"] <= 2 and touched["fact"] <= 2


def test_a_batch_applied_again_changes_nothing(spark, raw, tmp_path):
    path = str(tmp_path / "tables")
    rows = raw("bbva", *[changed(BBVA, source_id=i, cabecera=f"Shop {i}") for i in range(5)])
    batch = fact_stream.newest_records(rows)
    assert fact_stream.apply_changes(batch, path, buckets=4) == 5
    once = {name: files(f"{path}/{name}") for name in ("ids", "members", "fact")}
    assert fact_stream.apply_changes(batch, path, buckets=4) == 0
    assert {name: files(f"{path}/{name}") for name in once} == once
    # A run that died before the ids were written applies its changes again.
    fact = plain(fact_stream.read_fact(spark, path))
    two = fact_stream.newest_records(raw("bbva", changed(BBVA, source_id=1, cabecera="Next"), day="2025-07-01"))
    ids = keyed.read_keyed(spark, f"{path}/ids", spark.read.parquet(f"{path}/ids").drop("bucket_of_4").schema, 4)
    saved = ids.collect()
    assert fact_stream.apply_changes(two, path, buckets=4) == 1
    after = plain(fact_stream.read_fact(spark, path))
    assert after != fact
    keyed.upsert_keyed(spark.createDataFrame(saved, ids.schema), f"{path}/ids", "discount_id", 4)
    assert fact_stream.apply_changes(two, path, buckets=4) == 1
    assert plain(fact_stream.read_fact(spark, path)) == after


def test_one_content_of_most_offers_is_spread(spark, raw, tmp_path):
    path = str(tmp_path / "tables")
    rows = raw("bbva", *[changed(BBVA, source_id=i) for i in range(200)])
    fact_stream.apply_changes(fact_stream.newest_records(rows), path, buckets=64)
    assert fact_stream.read_fact(spark, path).count() == 1
    sizes = [r["count"] for r in spark.read.parquet(f"{path}/members").groupBy("member").count().collect()]
    assert len(sizes) == fact_stream.SALTS and max(sizes) < 60


def reported(frame) -> dict:
    return {r["column"]: (r["failing"], r["total"], r["status"]) for r in frame.collect()}


def test_duplicates_across_increments_are_found(spark, tmp_path):
    index = uniqueness.KeyIndex(spark, str(tmp_path / "digests"), "key_index_test", 4)
    schema = "k long, name string"
    first = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], schema)
    second = spark.createDataFrame([(2, "x"), (3, "a"), (4, None)], schema)
    check = lambda rows, of: reported(uniqueness.check_increment(rows, ["k", "name"], index, of))
    assert check(first, "one") == {"k": (1, 3, "error"), "name": (0, 4, "pass")}
    assert check(second, "two") == {"k": (1, 3, "error"), "name": (1, 2, "error")}
    # Checked again it meets its own digests only.
    assert check(second, "two") == {"k": (1, 3, "error"), "name": (1, 2, "error")}
    assert index.read().count() == 2 + 4 + 2 + 1
    assert check(first.where("false"), "three") == {"k": (0, 0, "pass"), "name": (0, 0, "pass")}
    # Another session knows the index by its folder, and a value by column.
    again = uniqueness.KeyIndex(spark, str(tmp_path / "digests"), "key_index_again", 4)
    late = spark.createDataFrame([(9, "1"), (1, "z")], schema)
    assert reported(uniqueness.check_increment(late, ["k", "name"], again, "four")) == {
        "k": (1, 2, "error"),
        "name": (0, 2, "pass"),
    }


def test_the_index_is_merged_without_a_shuffle(spark, tmp_path):
    index = uniqueness.KeyIndex(spark, str(tmp_path / "digests"), "key_index_plan", 4)
    rows = spark.range(2000).select(F.col("id").alias("k"))
    uniqueness.check_increment(rows, ["k"], index, "one")
    old = index.read().groupBy("digest", "name").agg(F.count("*").alias("n"))
    text = old._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_today_is_the_default_day(spark):
    from ofertario.operators import serving

    today = dt.date.today()
    rows = [(today - dt.timedelta(9), today + dt.timedelta(9)), (today - dt.timedelta(9), today - dt.timedelta(2))]
    frame = spark.createDataFrame(rows, "s date, e date")
    shown = frame.select(serving.is_active("s", "e").alias("a"), serving.is_active("s", "e", today).alias("b"))
    assert [tuple(r) for r in shown.collect()] == [(True, True), (False, False)]


@pytest.mark.parametrize("files_in_bucket", [1, 3])
def test_buckets_in_several_files(spark, tmp_path, files_in_bucket):
    path = str(tmp_path / "keyed")
    rows = spark.createDataFrame([(i, "v") for i in range(500)], SCHEMA)
    keyed.upsert_keyed(rows, path, "id", 2, files_in_bucket)
    assert plain(keyed.read_keyed(spark, path, rows.schema, 2)) == plain(rows)
    assert max(map(len, files(path).values())) <= files_in_bucket
