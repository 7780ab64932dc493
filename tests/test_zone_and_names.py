from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from payloads import BBVA, changed
from pyspark.sql import functions as F
from test_streaming import land

from ofertario.operators import name_index, search
from ofertario.sources import landing

DAYS = [dt.date(2025, 6, day) for day in (1, 2, 3)]


def taken(spark, tmp_path, days):
    found = landing.take_new_files(spark, str(tmp_path / "zone"), str(tmp_path / "ledger"), days).collect()
    return {(r.spider, r.scraped_at_dt.day): r.new_files for r in found}


def test_the_ledger_takes_each_file_once(spark, tmp_path):
    zone = tmp_path / "zone"
    land(zone, "bbva", "2025-06-01", "a.jsonl", BBVA)
    land(zone, "galicia", "2025-06-01", "a.jsonl", {})
    land(zone, "bbva", "2025-06-02", "a.jsonl", BBVA)
    assert taken(spark, tmp_path, DAYS) == {("bbva", 1): 1, ("galicia", 1): 1, ("bbva", 2): 1}
    assert taken(spark, tmp_path, DAYS) == {}
    land(zone, "bbva", "2025-06-02", "b.jsonl", BBVA)
    land(zone, "bbva", "2025-06-03", "a.jsonl", BBVA)
    # An old day is not listed; its file is taken once that day is asked for.
    land(zone, "bbva", "2025-06-01", "late.jsonl", BBVA)
    assert taken(spark, tmp_path, DAYS[1:]) == {("bbva", 2): 1, ("bbva", 3): 1}
    assert taken(spark, tmp_path, DAYS) == {("bbva", 1): 1}
    assert taken(spark, tmp_path, []) == {}
    assert taken(spark, tmp_path, [dt.date(2020, 1, 1)]) == {}


def test_stored_payloads_are_read_by_path(spark, raw, tmp_path):
    path = str(tmp_path / "payloads")
    rows = raw("bbva", *[changed(BBVA, source_id=i) for i in range(20)], None)
    landing.store_payloads(rows, path)
    stored = landing.read_payloads(spark, path)
    ids = stored.where("spider = 'bbva'").select(F.try_variant_get("raw_payload", "$.source_id", "bigint").alias("id"))
    text = ids._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<raw_payload:struct<0:bigint>>" in text
    assert sorted(r.id for r in ids.collect() if r.id is not None) == list(range(20))
    plain = lambda df: sorted(str(r[0]) for r in df.select(F.to_json("raw_payload")).collect())
    assert [json.loads(x) for x in plain(stored)[:1]] and plain(stored) == plain(rows)


NAMES = [
    "Coto", "COTO Digital", "Disco", "Carrefour", "Farmacity", "İstanbul Café", "Istanbul", "ıstakoz", "Straße 9",
    "STRASSE", "ẞ-Markt", "ΣΊΣΥΦΟΣ", "Σίσυφος", "Kelvin", "Kelvin", "Ångstrom", "Ångstrom", "ﬁnca", "Finca",
    "a.b", "a|b", "[x]", "Ǆungla", "ǆungla", "ſan", "San", "", "ab", "McDonald's", None, "𝐁anco", "co", "µTorrent", "Μtorrent",
]
TEXTS = [
    "coto", "CO", "disco|carre", "istanbul", "İstanbul", "ıstanbul", "strasse", "straße", "ẞ-m", "σίσυφοσ", "ΣΊΣΥ", "kelvin",
    "KELV", "ångstrom", "finca", "ﬁnca", "a.b", "^co", "ca(rr)?e", "ǆun", "san", "mcdonald's", "|coto", "xyz", "μtorr", "co.o",
]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("index"))
    draw = random.Random(3)
    rows = [(f"d{i}", name, draw.choice(["Super", "Bares", None])) for i, name in enumerate(NAMES * 3)]
    offers = spark.createDataFrame(rows, "discount_id string, merchant_name string, merchant_category_name string")
    offers.orderBy("merchant_name").coalesce(1).write.option("parquet.block.size", "1024").parquet(f"{folder}/offers")
    name_index.write_name_index(offers, folder)
    return spark.read.parquet(f"{folder}/offers"), folder


@pytest.mark.parametrize("literal", [False, True])
def test_the_index_finds_what_the_expression_finds(indexed, literal):
    offers, folder = indexed
    queries = [search.Query(merchant=t, literal=literal) for t in TEXTS]
    queries += [search.Query(merchant="coto", category="Super"), search.Query(category="Bares"), search.Query()]
    for query in queries:
        got = sorted(r.discount_id for r in name_index.by_name(offers, folder, query).collect())
        assert got == sorted(r.discount_id for r in search.prefiltered(offers, query).collect()), query


def test_many_names_are_joined(indexed, monkeypatch):
    offers, folder = indexed
    monkeypatch.setattr(name_index, "LONGEST_LIST", 1)
    query = search.Query(merchant="o")
    got = name_index.by_name(offers, folder, query)
    assert got.columns == offers.columns
    assert sorted(r.discount_id for r in got.collect()) == sorted(
        r.discount_id for r in search.prefiltered(offers, query).collect()
    )


def test_only_names_with_the_trigrams_are_tried(spark, indexed):
    offers, folder = indexed
    query = search.Query(merchant="coto|carrefour")
    plan = name_index.matching_names(spark, folder, query)._jdf.queryExecution().executedPlan().toString()
    assert "/trigrams" in plan and "PushedFilters: [In(trigram" in plan and "/names" not in plan
    found = name_index.by_name(offers, folder, query)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(merchant_name" in found and "RLIKE" not in found
    assert name_index.alternatives(search.Query(merchant="co.o")) is None
