from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from payloads import BBVA, GALICIA, NARANJAX, changed
from pyspark.sql import functions as F

from ofertario.operators import category, conform, dedup, merge, normalize
from ofertario.plans import build as plan
from ofertario.sources import landing, seeds, tables


def day(text):
    return dt.date.fromisoformat(text)


def bbva_rows(raw, *records):
    """Staged records from (source id, day, changes...)."""
    frames = [
        normalize.normalize_bbva(raw("bbva", changed(BBVA, source_id=i, **fields), day=d))
        for i, d, fields in records
    ]
    return conform.keep_worth_showing(conform.union_sources(frames))


def test_newest_record_wins(raw):
    rows = bbva_rows(
        raw,
        (1, "2025-06-01", {"category_name": "old"}),
        (1, "2025-06-08", {"category_name": "new"}),
        (2, "2025-06-01", {"category_name": "only"}),
    )
    kept = dedup.dedup_by_source(rows)
    assert {r.source_id: r.merchant_category_name for r in kept.collect()} == {"1": "new", "2": "only"}


def test_ties_of_one_day_are_settled_alike(raw):
    records = [(1, "2025-06-01", {"category_name": c, "seq": n}) for n, c in enumerate("abc")]
    winners, by_number = set(), set()
    for _ in range(3):
        random.shuffle(records)
        rows = bbva_rows(raw, *records)
        winners.add(dedup.dedup_by_source(rows).first().merchant_category_name)
        by_number.add(dedup.dedup_by_source(rows, "$.seq").first().merchant_category_name)
    assert len(winners) == 1
    assert by_number == {"c"}


def test_dedup_twice_changes_nothing(raw):
    rows = bbva_rows(raw, (1, "2025-06-01", {}), (1, "2025-06-02", {}), (2, "2025-06-02", {}))
    once = dedup.dedup_by_source(rows).drop("discount_id")
    assert sorted(map(str, dedup.dedup_by_source(once).drop("discount_id").collect())) == sorted(
        map(str, once.collect())
    )
    content = dedup.dedup_by_content(dedup.dedup_by_source(rows))
    again = dedup.dedup_by_content(content.drop("discount_content_hash"))
    assert again.count() == content.count() == 1


def content(raw, spider, payload, **fields):
    rows = normalize.NORMALIZERS[spider](raw(spider, changed(payload, **fields)))
    hashed = dedup.with_content_hash(conform.union_sources([rows]))
    return hashed.first().discount_content_hash


def test_content_hash_ignores_list_order_and_ids(raw):
    same = content(raw, "naranjax", NARANJAX, paymentMethods=["dinero", "credito"])
    assert content(raw, "naranjax", NARANJAX, id="other") == same
    days = {"days__weekdaysApplied": [5, 1, 3]}
    assert content(raw, "naranjax", NARANJAX, **days) == same


def test_content_hash_tells_content_apart(raw):
    base = content(raw, "galicia", GALICIA, topeReintegro="0")
    assert content(raw, "galicia", GALICIA, topeReintegro="") != base
    upper = changed(GALICIA, topeReintegro="0")
    upper["marca"]["nombre"] = "COTO"
    assert content(raw, "galicia", upper) != base


def brute_ranks(rows, key, order):
    ranks = {}
    for row in sorted(rows, key=order):
        ranks.setdefault(row[key], []).append(row["i"])
    return {i: n + 1 for ids in ranks.values() for n, i in enumerate(ids)}


def test_rank_within_a_group_of_most_rows(spark):
    rng = random.Random(3)
    rows = [
        {"i": i, "k": rng.choice(["hot"] * 8 + ["a", "b", None]), "d": rng.choice([1, 2, None])}
        for i in range(400)
    ]
    frame = spark.createDataFrame(
        [(r["i"], r["k"], r["d"]) for r in rows], "i bigint, k string, d bigint"
    )
    ranked = dedup.rank_within(
        frame,
        ["k"],
        [F.desc_nulls_last("d"), F.asc("i")],
        [(F.coalesce("d", F.lit(-1)), True), (F.floor(F.col("i") / 50), False)],
    )
    expected = brute_ranks(rows, "k", lambda r: (-(r["d"] or -1), r["i"]))
    assert {r.i: r.rn for r in ranked.collect()} == expected
    hot = [r["i"] for r in rows if r["k"] == "hot"]
    assert len(hot) > 200


def test_latest_by_limits_keys_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    kept = dedup.latest_by(frame, ["k"], [F.desc("id")])
    plan_text = kept._jdf.queryExecution().executedPlan().toString()
    partial = plan_text.index("row_number(), 1, Partial")
    assert plan_text.index("Exchange") < partial
    assert sorted(tuple(r) for r in kept.collect()) == [(0, 98), (1, 99)]


def test_audit_ranks_and_dedup_agree(raw):
    rows = bbva_rows(
        raw,
        (1, "2025-06-01", {}),
        (2, "2025-06-02", {}),
        (3, "2025-06-02", {}),
        (4, "2025-06-01", {"cabecera": "Otro 10%"}),
    )
    deduped = dedup.dedup_by_source(rows)
    audit = dedup.dedup_audit(deduped.drop("discount_metadata", "record_order"))
    assert sorted(r.rn for r in audit.collect()) == [1, 1, 2, 3]
    first = {r.discount_id for r in audit.filter("rn = 1").collect()}
    assert {r.discount_id for r in dedup.dedup_by_content(deduped).collect()} == first


def test_category_chain(spark):
    rows = spark.createDataFrame(
        [
            (1, "COTO", "Banco BBVA", "Moda"),
            (2, "zara", "banco bbva", "moda"),
            (3, "coca-cola", "Banco BBVA", "Nada"),
            (4, None, None, None),
            (5, "Cafe", "Banco Galicia", "Confiteria"),
        ],
        "id int, merchant_name string, issuer_name string, merchant_category_name string",
    )
    resolved = category.resolve_category(
        rows, seeds.read_seed(spark, "merchant_overrides"), seeds.read_seed(spark, "merchant_categories")
    )
    assert {r.id: (r.merchant_name, r.merchant_category_clean) for r in resolved.collect()} == {
        1: ("Coto", "Supermercados"),
        2: ("Zara", "Moda e indumentaria"),
        3: ("Coca-Cola", "Sin categorizar"),
        4: (None, "Sin categorizar"),
        5: ("Cafe", "Sin categorizar"),
    }
    assert "merchant_category_name" not in resolved.columns


FACT = "id string, v string, last_updated_at_date date"


def test_incremental_predicate(spark):
    rows = spark.createDataFrame([("a", "1", day("2025-01-01")), ("b", "2", day("2025-01-02"))], FACT)
    target = rows.filter("id = 'a'")
    assert [r.id for r in merge.newer_than(rows, target).collect()] == ["b"]
    assert merge.newer_than(rows, target.filter("false")).count() == 0
    assert merge.up_to(rows, day("2025-01-01")).count() == 1
    assert merge.up_to(rows, None).count() == 2


def test_upsert_replaces_inserts_and_keeps(spark):
    target = spark.createDataFrame([("a", "old", None), ("b", "old", None)], FACT)
    incoming = spark.createDataFrame([("b", "new", None), ("c", "new", None)], FACT)
    once = merge.upsert(target, incoming)
    expected = {"a": "old", "b": "new", "c": "new"}
    assert {r.id: r.v for r in once.collect()} == expected
    twice = merge.upsert(once, incoming)
    assert {r.id: r.v for r in twice.collect()} == expected and twice.count() == 3


def test_versions_follow_the_log(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.read_version(spark, path) is None
    first = spark.createDataFrame([("a", "1", None)], FACT)
    assert tables.write_version(first, path) == 1
    both = tables.read_version(spark, path).unionByName(spark.createDataFrame([("b", "1", None)], FACT))
    # Files of a run that died before its log entry are not a version.
    first.write.parquet(f"{path}/version=2")
    assert tables.current_version(spark, path) == 1
    assert tables.write_version(both, path) == 2
    assert tables.read_version(spark, path).count() == 2
    assert tables.read_version(spark, path, 1).count() == 1


def payloads(raw):
    frames = [
        raw("bbva", *[changed(BBVA, source_id=i) for i in (1, 2)], day="2025-06-01"),
        raw("galicia", changed(GALICIA, tiendaFisica=True), day="2025-06-01"),
        raw("naranjax", NARANJAX, day="2025-06-08"),
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def test_load_in_steps(raw, tmp_path):
    rows = plan.offers(payloads(raw))
    path = str(tmp_path / "fact")
    plan.load_fact(rows, path, cutoff=day("2025-06-01"))
    assert tables.read_version(rows.sparkSession, path).count() == 2
    plan.load_fact(rows, path)
    assert tables.read_version(rows.sparkSession, path).count() == 3
    late = rows.withColumn("last_updated_at_date", F.lit(day("2025-06-08")))
    plan.load_fact(late, path)
    fact = tables.read_version(rows.sparkSession, path)
    assert fact.count() == 3
    assert fact.columns == list(merge.FACT_COLUMNS)


@pytest.mark.parametrize("audit", [False, True])
def test_build_publishes_and_reports(spark, raw, tmp_path, audit):
    path = str(tmp_path / "out")
    result = plan.build(
        spark, payloads(raw), path, as_of=day("2025-07-01"), enforce=False, audit=audit
    )
    serving = tables.read_version(spark, f"{path}/serving")
    issuers = tables.read_version(spark, f"{path}/issuers")
    assert serving.count() == 3 and len(serving.columns) == 20
    assert {r.issuer_name: r.discount_count for r in issuers.collect()} == {
        "Banco BBVA": 1,
        "Banco Galicia": 1,
        "Naranja X": 1,
    }
    assert {r.issuer_name: r.discount_is_active for r in serving.collect()}["Banco Galicia"] is False
    assert {"raw_bbva", "staging_naranjax", "offers", "fact"} <= set(result.reports)
    staged = {(r["check"], r["column"]): r for r in result.reports["staging_bbva"]}
    assert staged[("not_null", "source_id")]["total"] == 2
    if audit:
        assert spark.read.parquet(f"{path}/audit").count() == 4


def test_build_stops_on_an_error(spark, raw, tmp_path):
    from ofertario.operators.quality import ChecksFailed

    bad = payloads(raw).unionByName(raw("bbva", changed(BBVA, source_id=9, cabecera=None)))
    with pytest.raises(ChecksFailed, match="merchant_name"):
        plan.build(spark, bad, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_ten_null_payloads_stop_a_build(spark, raw, tmp_path):
    from ofertario.operators.quality import ChecksFailed

    rows = payloads(raw).unionByName(raw("bbva", *[None] * 10, day="2025-06-01"))
    with pytest.raises(ChecksFailed, match="has_required_keys"):
        plan.build(spark, rows, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()
    few = payloads(raw).unionByName(raw("bbva", *[None] * 9, day="2025-06-01"))
    result = plan.build(spark, few, str(tmp_path / "few"), as_of=day("2025-07-01"))
    keys, unread = result.reports["raw_bbva"]
    assert keys["failing"] == unread["failing"] == 9 and keys["status"] == "warn"


def test_a_failing_fact_is_never_visible(spark, raw, tmp_path, monkeypatch):
    from ofertario.operators import quality

    path = str(tmp_path / "out")
    first = plan.build(spark, payloads(raw), path, as_of=day("2025-07-01"))
    later = raw("bbva", changed(BBVA, source_id=7), day="2025-06-20")
    monkeypatch.setattr(quality, "fact_checks", lambda: [quality.is_true(F.lit(False), "never")])
    with pytest.raises(quality.ChecksFailed, match="never"):
        plan.build(spark, later, path, as_of=day("2025-07-01"))
    assert tables.current_version(spark, f"{path}/fact") == first.version
    assert tables.current_version(spark, f"{path}/serving") == 1


def test_incremental_build_reads_newer_partitions_only(spark, raw, tmp_path):
    zone, path = str(tmp_path / "zone"), str(tmp_path / "out")
    landing.write_landing(payloads(raw), zone)
    read = lambda: landing.read_landing(spark, zone, spider=["bbva", "galicia", "naranjax"])
    plan.build(spark, read(), path, as_of=day("2025-07-01"))
    landing.write_landing(raw("bbva", changed(BBVA, source_id=3), day="2025-06-15"), zone)
    target = tables.read_version(spark, f"{path}/fact")
    new = plan.newer_partitions(read(), target)
    scan = new._jdf.queryExecution().executedPlan().toString()
    filters = scan[scan.index("PartitionFilters") :].split("]")[0]
    assert re.search(r"scraped_at_dt#\d+ > ", filters)
    assert new.count() == 1
    result = plan.build(spark, read(), path, as_of=day("2025-07-01"), keep=1)
    assert result.reports["raw_bbva"][0]["total"] == 1
    fact = tables.read_version(spark, f"{path}/fact")
    assert fact.count() == 4 and {r.last_updated_at_date for r in fact.collect()} >= {day("2025-06-15")}
    for name in ("fact", "serving", "issuers"):
        assert sorted(p.name for p in (tmp_path / "out" / name).glob("version=*")) == ["version=2"]


def test_a_build_removes_its_scratch(spark, raw, tmp_path):
    from pathlib import Path

    from ofertario.session import shared_folder

    shared = Path(shared_folder(spark).removeprefix("file:"))
    before = set(shared.glob("*"))
    plan.build(spark, payloads(raw), str(tmp_path / "out"), as_of=day("2025-07-01"))
    assert set(shared.glob("*")) == before


def test_a_large_payment_seed_builds(spark, raw, tmp_path):
    columns = "raw_tarjeta string, raw_tipoTarjeta string, parsed_type string, parsed_card_network string, parsed_card_tier string"
    built_in = seeds.read_seed(spark, "galicia_payment_methods")
    more = spark.createDataFrame([(f"t{i}", "x", "a", "b", "c") for i in range(300)], columns)
    facts = []
    for name, seed in (("small", built_in), ("large", built_in.unionByName(more))):
        path = str(tmp_path / name)
        plan.build(spark, payloads(raw), path, as_of=day("2025-07-01"), seeds={"galicia_payment_methods": seed})
        facts.append(sorted(map(str, tables.read_version(spark, f"{path}/fact").collect())))
    assert facts[0] == facts[1]


def test_build_without_rows_of_a_source(spark, raw, tmp_path):
    only = raw("bbva", BBVA).withColumn("spider", F.lit("bbva"))
    result = plan.build(spark, only, str(tmp_path / "a"), as_of=day("2025-07-01"))
    assert result.reports["raw_galicia"][0]["total"] == 0
    assert tables.read_version(spark, str(tmp_path / "a" / "fact")).count() == 1
    nothing = plan.build(spark, only.filter("false"), str(tmp_path / "b"))
    assert tables.read_version(spark, str(tmp_path / "b" / "fact"), nothing.version).count() == 0


def test_build_with_own_seeds_counts_unreadable_records(spark, raw, tmp_path):
    broken = payloads(raw).filter("spider = 'bbva'").limit(1)
    broken = broken.withColumn("raw_payload", F.lit(None).cast("variant"))
    seed = seeds.values_frame(
        spark,
        seeds.SEEDS["merchant_overrides"][0],
        [("STARBUCKS", "Café"), ("Farmacity", "Salud")],
    )
    cards = seeds.values_frame(
        spark,
        seeds.SEEDS["bbva_payment_methods"][0],
        [("Tarjetas de crédito BBVA", "credit_card", "visa", "Oro")],
    )
    result = plan.build(
        spark,
        payloads(raw).unionByName(broken),
        str(tmp_path / "out"),
        enforce=False,
        seeds={"merchant_overrides": seed, "bbva_payment_methods": cards},
    )
    reports = {r["check"]: r for r in result.reports["raw_bbva"]}
    assert (reports["has_payload"]["failing"], reports["has_payload"]["status"]) == (1, "warn")
    assert reports["has_required_keys"]["failing"] == 0
    fact = {r.issuer_name: r for r in tables.read_version(spark, str(tmp_path / "out" / "fact")).collect()}
    assert fact["Banco BBVA"].merchant_category_name == "Café"
    assert tuple(fact["Banco BBVA"].payment_methods_list[0]) == ("credit_card", "visa", "Oro")
    assert fact["Naranja X"].merchant_category_name == "Salud"


def test_published_layout_skips_other_categories(spark, tmp_path):
    from pyspark.sql import Window

    offers = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderstatus").alias("issuer_name"),
        F.col("o_orderpriority").alias("merchant_category_name"),
        F.col("o_custkey").cast("string").alias("merchant_name"),
    )
    missing = {
        c: F.lit(None).cast("date" if c.endswith("date") else "string")
        for c in merge.FACT_COLUMNS
        if c not in offers.columns
    }
    rows = plan.laid_out(offers.withColumns(missing), as_of=day("2025-01-01"))
    tables.write_version(rows, str(tmp_path / "serving"))
    back = tables.read_version(spark, str(tmp_path / "serving"))
    assert back.count() == offers.count()
    files = back.groupBy(F.input_file_name().alias("f")).agg(
        F.min("merchant_category_name").alias("low"), F.max("merchant_category_name").alias("high")
    )
    spans = files.withColumn("before", F.lag("high").over(Window.orderBy("low", "high")))
    assert spans.filter("before > low").count() == 0


def test_scratch_never_falls_back_to_a_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from ofertario.session import shared_folder

    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(RuntimeError):
        shared_folder(cluster)
