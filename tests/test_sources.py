from __future__ import annotations

import datetime as dt
import json

import pytest
from payloads import BBVA
from pyspark.sql import functions as F

from ofertario.functions import jsonx
from ofertario.sources import assemble, landing, seeds


def lines(folder, spider, day, *texts):
    target = folder / f"spider={spider}" / f"scraped_at_dt={day}"
    target.mkdir(parents=True, exist_ok=True)
    (target / "a.jsonl").write_text("\n".join(texts), encoding="utf8")


@pytest.fixture
def zone(tmp_path):
    good = json.dumps({"raw_payload": {"id": 1, "nothing": None}})
    lines(tmp_path, "bbva", "2025-06-01", good, "{broken", json.dumps({"raw_payload": None}))
    lines(tmp_path, "galicia", "2025-06-08", good)
    return str(tmp_path)


def test_landing_needs_a_filter(spark, zone):
    with pytest.raises(ValueError):
        landing.read_landing(spark, zone)


def test_landing_prunes_partitions(spark, zone):
    raw = landing.read_landing(spark, zone, spider="bbva", since=dt.date(2025, 6, 1))
    assert raw.dtypes == [
        ("raw_payload", "variant"),
        ("spider", "string"),
        ("scraped_at_dt", "date"),
    ]
    text = raw._jdf.queryExecution().executedPlan().toString()
    filters = text[text.index("PartitionFilters"):]
    assert "spider" in filters and "scraped_at_dt" in filters.split("PushedFilters")[0]
    assert raw.count() == 3
    assert landing.read_landing(spark, zone, until=dt.date(2025, 6, 1)).count() == 3
    assert landing.read_landing(spark, zone, since=dt.date(2025, 6, 2)).count() == 1


def test_unusable_lines_are_left_out_and_counted(spark, zone):
    raw = landing.read_landing(spark, zone, spider=["bbva", "galicia"])
    assert landing.usable(raw).count() == 2
    assert [tuple(r) for r in landing.rejects(raw).collect()] == [("bbva", dt.date(2025, 6, 1), 2)]


@pytest.mark.parametrize("files", [None, 2])
def test_landing_round_trip_keeps_nulls(spark, raw, tmp_path, files):
    path = str(tmp_path / "zone")
    landing.write_landing(raw("bbva", {**BBVA, "nothing": None}, BBVA), path, files)
    back = landing.read_landing(spark, path, spider="bbva")
    present = back.filter(jsonx.has_key("raw_payload", "$.nothing"))
    assert (back.count(), present.count()) == (2, 1)


def test_empty_frames_write_no_file(raw, tmp_path):
    path = tmp_path / "zone"
    landing.write_landing(raw("bbva", BBVA).filter("false"), str(path))
    assert not list(path.glob("spider=*"))


def test_new_files_gate(spark, zone):
    early, late = dt.datetime(2000, 1, 1), dt.datetime(2200, 1, 1)
    assert landing.assert_new_files(spark, zone, early) == {"bbva": 1, "galicia": 1}
    with pytest.raises(landing.NothingNew):
        landing.assert_new_files(spark, zone, late)


def test_seed_csv_with_mark_and_blanks(spark, tmp_path):
    text = "﻿raw_payment_method,parsed_type,parsed_card_network,parsed_card_tier\ndinero,account_money,,\n"
    (tmp_path / "seed.csv").write_text(text, encoding="utf8")
    seed = seeds.read_seed(spark, "naranja_payment_methods", str(tmp_path / "seed.csv"))
    assert [tuple(r) for r in seed.collect()] == [("dinero", "account_money", None, None)]


@pytest.mark.parametrize("name,rows", [("merchant_categories", 50), ("merchant_overrides", 15), ("issuer_icons", 3)])
def test_built_in_seeds(spark, name, rows):
    seed = seeds.read_seed(spark, name)
    assert seed.count() == rows and seed.columns == seeds.SEEDS[name][0]


def bodies(spark, rows, schema):
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumn("body", F.parse_json("body")).withColumn(
        "scraped_at_dt", F.to_date(F.lit("2025-06-01"))
    )


def items(frame):
    texts = frame.select(F.to_json("raw_payload").alias("t")).collect()
    return sorted((json.loads(r.t) for r in texts), key=str)


def test_assemble_bbva(spark):
    page = {"data": [{"id": 5, "fechaDesde": "a", "subcabecera": "s"}, {"id": None}, {"id": 0}, {"id": 6}]}
    catalogue = bodies(
        spark, [("Moda", json.dumps(page)), ("Otros", json.dumps({"data": [{"id": 5}]}))],
        "category_name string, body string",
    )
    detail = {"data": {"cabecera": "C", "subcabecera": "detail", "nothing": None}}
    details = bodies(spark, [("5", json.dumps(detail))], "id string, body string")
    found = items(assemble.assemble_bbva(catalogue, details))
    assert found[0] == {
        "source_id": 5,
        "discount_start_date": "a",
        "discount_end_date": None,
        "subcabecera": "detail",
        "category_name": "Moda",
        "cabecera": "C",
        "nothing": None,
    } or found[1]["category_name"] == "Moda"
    assert {i["category_name"] for i in found} == {"Moda", "Otros"}
    assert all(i["subcabecera"] == "detail" for i in found)


def test_assemble_galicia(spark):
    catalogue = bodies(
        spark, [(json.dumps({"data": {"list": [{"id": "g"}, {"id": ""}]}}),)], "body string"
    )
    details = bodies(spark, [("g", json.dumps({"data": {"a": [1]}}))], "id string, body string")
    assert items(assemble.assemble_galicia(catalogue, details)) == [{"source_id": "g", "a": [1]}]


def test_assemble_naranjax(spark):
    page = {
        "data": [
            {"url": "one", "urlDetail": "p", "fullUrl": "u1"},
            {"url": "many", "fullUrl": "u2"},
            {"url": "down", "fullUrl": "u3"},
        ]
    }
    catalogue = bodies(spark, [(json.dumps(page),)], "body string")
    near = json.dumps({"nearCurrent": [{"url": "x"}, {"url": "y"}]})
    commerces = bodies(
        spark, [("many", 200, near), ("down", 403, near)], "commerce string, status int, body string"
    )
    details = bodies(
        spark,
        [
            ("one", "p", 200, '{"k":1}'),
            ("many", "x", 200, '{"k":2,"discount_url":"own"}'),
            ("many", "y", 500, '{"k":3}'),
            ("down", "x", 200, '{"k":4}'),
        ],
        "commerce string, plan string, status int, body string",
    )
    assert items(assemble.assemble_naranjax(catalogue, commerces, details)) == sorted(
        [
            {"id": "one_p", "discount_url": "u1", "k": 1},
            {"id": "many_x", "discount_url": "own", "k": 2},
        ],
        key=str,
    )


def test_page_counts(one):
    assert one(assemble.page_count_of(F.lit(21), F.lit(10))) == 3
    assert one(assemble.page_count_in(F.lit("ok, paginas:  12"))) == 12
    assert one(assemble.page_count_in(F.lit("ok"))) is None
