from __future__ import annotations

import json

from payloads import BBVA, NARANJAX, changed
from pyspark.sql import functions as F

from ofertario.operators import dedup, merge, metrics
from ofertario.plans import build as plan
from ofertario.sources import landing, tables
from ofertario.streaming import alerts, landing_stream


def land(zone, spider, day, name, *payloads):
    folder = zone / f"spider={spider}" / f"scraped_at_dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(json.dumps({"raw_payload": p}) for p in payloads)
    (folder / name).write_text(text, encoding="utf8")


def run(spark, tmp_path, **options):
    stream = landing_stream.read_landing_stream(spark, str(tmp_path / "zone"), **options)
    landing_stream.start_landing_stream(
        stream, str(tmp_path / "newest"), str(tmp_path / "checkpoint")
    ).awaitTermination()
    return landing_stream.read_newest(spark, str(tmp_path / "newest"))


def plain(df):
    texts = df.select(F.to_json(F.struct(*sorted(df.columns))).alias("t")).collect()
    return sorted(r.t for r in texts)


def batch(spark, tmp_path):
    raw = landing.read_landing(spark, str(tmp_path / "zone"), spider=["bbva", "naranjax"])
    staging = plan.without_payload(plan.keep_worth_showing(plan.staged(landing.usable(raw))))
    return dedup.dedup_by_source(staging)


def test_stream_in_any_split_equals_one_batch_load(spark, tmp_path):
    zone = tmp_path / "zone"
    land(zone, "bbva", "2025-06-01", "a.jsonl", *[changed(BBVA, source_id=i) for i in (1, 2)])
    land(zone, "naranjax", "2025-06-01", "a.jsonl", NARANJAX)
    first = run(spark, tmp_path)
    assert first.count() == 3
    # A newer record, an older one that arrives late, a new id, a broken line.
    land(zone, "bbva", "2025-06-08", "a.jsonl", changed(BBVA, source_id=1, category_name="new"))
    land(zone, "bbva", "2025-05-25", "a.jsonl", changed(BBVA, source_id=2, category_name="late"))
    land(zone, "naranjax", "2025-06-08", "a.jsonl", changed(NARANJAX, id="n2"))
    second = run(spark, tmp_path, files_per_batch=1)
    assert plain(second) == plain(batch(spark, tmp_path))
    assert {r.source_id: r.merchant_category_name for r in second.collect()} == {
        "1": "new",
        "2": "Gastronomía",
        "n1": "Salud y bienestar",
        "n2": "Salud y bienestar",
    }
    offers = landing_stream.streamed_offers(spark, str(tmp_path / "newest"))
    assert offers.count() == plan.normalised(batch(spark, tmp_path)).count()


def test_replayed_batch_changes_nothing(spark, raw, tmp_path):
    table = str(tmp_path / "newest")
    rows = raw("bbva", *[changed(BBVA, source_id=i) for i in (1, 2)])
    landing_stream.append_newest(rows, table, 0)
    once, checks = plain(landing_stream.read_newest(spark, table)), plain(landing_stream.streamed_checks(spark, table))
    landing_stream.append_newest(rows, table, 0)
    assert plain(landing_stream.read_newest(spark, table)) == once
    assert plain(landing_stream.streamed_checks(spark, table)) == checks
    assert landing_stream.streamed_offers(spark, str(tmp_path / "none")) is None


def test_a_batch_writes_what_it_holds(spark, raw, tmp_path):
    table = str(tmp_path / "newest")
    landing_stream.append_newest(raw("bbva", *[changed(BBVA, source_id=i) for i in range(40)]), table, 0)
    for number in (1, 2):
        landing_stream.append_newest(raw("bbva", changed(BBVA, source_id=number), None, day="2025-07-01"), table, number)
        assert spark.read.parquet(f"{table}/batch={number}").count() == 1
    assert landing_stream.read_newest(spark, table).count() == 40
    counted = {(r.of, r.check): (r.failing, r.total) for r in landing_stream.streamed_checks(spark, table).collect()}
    assert counted[("raw_bbva", "has_payload")] == (2, 44)
    assert counted[("raw_galicia", "has_payload")] == (0, 0)
    assert landing_stream.compact(spark, table, str(tmp_path / "whole")) == 1
    assert tables.read_version(spark, str(tmp_path / "whole")).count() == 40


def test_stream_reaches_the_fact(spark, tmp_path):
    zone = tmp_path / "zone"
    for day in ("2025-06-01", "2025-06-08", "2025-06-15"):
        land(zone, "bbva", day, "a.jsonl", *[changed(BBVA, source_id=i, cabecera=f"Shop {i}") for i in (1, 2)])
    run(spark, tmp_path, files_per_batch=1)
    path = str(tmp_path / "fact")
    assert landing_stream.stream_fact(spark, str(tmp_path / "newest"), path) == 1
    expected = merge.fact_columns(plan.normalised(batch(spark, tmp_path)))
    assert plain(tables.read_version(spark, path)) == plain(expected)


def test_streamed_alerts_equal_batch_alerts(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").cast("string").alias("workflow_id"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("OK").alias("status"),
    )
    events.repartition(4).write.parquet(str(tmp_path / "runs"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(
        str(tmp_path / "runs")
    )

    def keep(batch_rows, number):
        batch_rows.withColumn("batch", F.lit(number)).write.parquet(str(tmp_path / "out" / f"batch={number}"))

    alerts.streaming_failure_alerts(stream, lateness="60 days").writeStream.outputMode(
        "update"
    ).foreachBatch(keep).option("checkpointLocation", str(tmp_path / "cp")).trigger(
        availableNow=True
    ).start().awaitTermination()
    updates = spark.read.parquet(str(tmp_path / "out"))
    final = dedup.latest_by(updates, ["window_start", "workflow_id"], [F.desc("batch")]).drop("batch")
    expected = metrics.failure_alerts(events)
    assert sorted(map(str, final.collect())) == sorted(map(str, expected.collect()))
