from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ofertario.operators import issuers, metrics, quality, search, serving
from ofertario.sources import seeds


def reported(df, *checks):
    return {(r["check"], r["column"]): r for r in map(lambda r: r.asDict(), quality.run_checks(df, checks).collect())}


def test_basis_point_check(spark):
    rows = [(True,)] * 96 + [(False,)] * 3 + [(None,)]
    frame = spark.createDataFrame(rows, "ok boolean")
    row = reported(frame, quality.is_true_share(F.col("ok"), "ok"))[("is_true_share", "ok")]
    assert (row["failing"], row["total"], row["metric"], row["status"]) == (3, 100, 300, "warn")
    empty = reported(frame.filter("false"), quality.is_true_share(F.col("ok"), "ok"))
    assert empty[("is_true_share", "ok")]["status"] == "pass"


def test_row_checks(spark):
    frame = spark.createDataFrame(
        [(1, 0.5, [0, 6], "a"), (1, 2.0, [], "b"), (None, None, None, None), (3, -1.0, [7, 8, None], "a")],
        "id bigint, rate double, days array<bigint>, kind string",
    )
    rows = reported(
        frame,
        quality.not_null("id"),
        quality.unique("id"),
        quality.between("rate", 0, 1),
        quality.between("rate", low=0),
        quality.elements_between("days"),
        quality.not_empty("days"),
        quality.not_in("kind", ["b"]),
        quality.is_true(F.col("rate") < 1, "low"),
    )
    failing = {k: v["failing"] for k, v in rows.items() if k != ("between", "rate")}
    assert failing == {
        ("not_null", "id"): 1,
        ("unique", "id"): 1,
        ("elements_between", "days"): 2,
        ("not_empty", "days"): 1,
        ("not_in", "kind"): 1,
        ("is_true", "low"): 1,
    }
    both = [r.failing for r in quality.run_checks(frame, [quality.between("rate", 0, 1)]).collect()]
    assert both == [2]


def test_required_keys_thresholds(spark, raw):
    frame = raw("bbva", *([{"a": 1}] * 3 + [{"a": None, "b": 1}] * 2))
    check = quality.has_required_keys("raw_payload", ["a", "b"], F.col("spider") == "bbva")
    row = reported(frame, check)[("has_required_keys", "raw_payload")]
    assert (row["failing"], row["total"], row["status"]) == (3, 5, "warn")
    other = quality.has_required_keys("raw_payload", ["a", "b"], F.col("spider") == "galicia")
    assert reported(frame, other)[("has_required_keys", "raw_payload")]["total"] == 0


def test_observed_counts_equal_run_checks(spark, tmp_path):
    frame = spark.range(1000).select(F.when(F.col("id") % 7 > 0, F.col("id")).alias("id"))
    checks = [quality.not_null("id"), quality.between("id", 10, 900)]
    seen, observation = quality.observed(frame, checks, "seen")
    seen.write.parquet(str(tmp_path / "out"))
    report = quality.observed_report(spark, observation, checks)
    assert report.collect() == quality.run_checks(frame, checks).collect()


def test_severity_and_enforcement(spark, one):
    assert one(F.expr(quality.severity("0", 0, 500))) == "pass"
    assert one(F.expr(quality.severity("500", 0, 500))) == "warn"
    assert one(F.expr(quality.severity("501", 0, 500))) == "error"
    assert one(F.expr(quality.severity("9", None, None))) == "pass"
    frame = spark.createDataFrame([(None,)], "id bigint")
    with pytest.raises(quality.ChecksFailed):
        quality.enforce(quality.run_checks(frame, [quality.not_null("id")]))
    assert quality.enforce(quality.run_checks(frame, [quality.not_null("id", error=5)]))


def test_reconciliation(spark):
    fact = spark.createDataFrame([("a",), ("a",), ("b",)], "issuer_name string").withColumn(
        "last_updated_at_date", F.current_date()
    )
    summary = serving.issuer_summary(fact)
    assert quality.reconcile(fact, summary).count() == 0
    assert serving.summary_totals(summary).first().asDict() == {"issuers": 2, "discounts": 3}
    unnamed = fact.unionByName(fact.limit(1).withColumn("issuer_name", F.lit(None).cast("string")))
    assert quality.reconcile(unnamed, serving.issuer_summary(unnamed)).count() == 1


@pytest.fixture(scope="module")
def offers(spark):
    method = "array<struct<type:string,card_network:string,card_tier:string>>"
    card, cash = [("credit_card", "visa", None)], [("account_money", None, None)]
    rows = [
        ("1", "A", "Coto", "Super", True, 0.1, 3, [0, 1], True, True, card),
        ("2", "A", "coto", "Super", False, 0.4, 0, [2], True, None, cash),
        ("3", "B", "Café (sur)", "Cafe", True, None, 6, [2], False, True, card + cash),
        ("4", "B", None, "Cafe", True, 0.4, 0, None, None, None, None),
        ("5", "A", "Coto", "Super", True, 0.4, 0, [5], False, True, card),
    ]
    return spark.createDataFrame(
        rows,
        "discount_id string, issuer_name string, merchant_name string, merchant_category_name string,"
        "discount_is_active boolean, discount_rate double, discount_no_interest_installment_qty bigint,"
        "discount_valid_days_list array<bigint>, discount_valid_online boolean,"
        f"discount_valid_instore boolean, discount_payment_methods_list {method}",
    )


@pytest.mark.parametrize(
    "fields,ids",
    [
        ({}, []),
        ({"merchant": "  "}, []),
        ({"merchant": "COTO", "issuers": []}, []),
        ({"merchant": " COTO "}, ["5", "1"]),
        ({"merchant": "COTO", "include_inactive": True}, ["5", "2", "1"]),
        ({"merchant": "COTO", "order_by": "installments"}, ["1", "5"]),
        ({"merchant": "CAFÉ .sur"}, ["3"]),
        ({"merchant": "(SUR)", "literal": True}, ["3"]),
        ({"category": "Cafe"}, ["4", "3"]),
        ({"category": "Cafe", "days": [2, 3]}, ["3"]),
        ({"category": "Super", "merchants": ["Coto"], "formato": "Solo Presencial"}, ["5"]),
        ({"category": "Cafe", "formato": "Ver legales"}, ["4"]),
        ({"category": "Cafe", "payment_types": ["Dinero en cuenta"]}, ["3"]),
    ],
)
def test_search(offers, fields, ids):
    query = search.Query(**{"issuers": ["A", "B"], **fields})
    assert [r.discount_id for r in search.search(offers, query).collect()] == ids


def test_pages_and_counts(offers):
    query = search.Query(category="Super", issuers=["A"], include_inactive=True)
    pages = [search.search(offers, query, 1, n).first().discount_id for n in range(3)]
    assert pages == ["5", "2", "1"]
    assert search.found_count(offers, query).first().discounts == 3
    active = search.Query(category="Super")
    assert search.found_count(offers, active).first().discounts == 2


def test_facets(offers):
    query = search.Query(category="Cafe", issuers=["B"])
    lists = {k: [r.value for r in df.collect()] for k, df in search.facets(offers, query).items()}
    assert lists == {
        "category": ["Cafe", "Super"],
        "issuer": ["B"],
        "merchant": ["Café (sur)"],
        "formato": ["Solo Presencial", "Ver legales"],
        "payment_type": ["Dinero en cuenta", "Tarjeta de crédito"],
    }
    one_pass = {(r.facet, r.value) for r in search.facet_values(offers, query).collect()}
    assert one_pass == {(k, v) for k in ("merchant", "formato", "payment_type") for v in lists[k]}


def test_active_flag(spark):
    frame = spark.createDataFrame(
        [(dt.date(2025, 1, 1), dt.date(2025, 6, 1))], "start_date date, end_date date"
    )

    def active(as_of):
        return frame.select(serving.is_active("start_date", "end_date", as_of)).first()[0]

    assert active(dt.date(2025, 1, 1)) is True
    assert active(dt.date(2025, 6, 1)) is False


def test_issuer_status(spark):
    summary = spark.createDataFrame(
        [("Banco BBVA", "2025-06-01", "12"), ("Otro", "bad", "x")],
        "issuer_name string, last_scraped_at string, discount_count string",
    )
    rows = {r.issuer_name: r for r in issuers.issuer_status(summary, seeds.read_seed(spark, "issuer_icons")).collect()}
    assert rows["Banco BBVA"].icon_file == "bbva.png"
    assert rows["Banco BBVA"].last_scraped_label == "01/06/2025 00:00"
    assert (rows["Otro"].last_scraped_label, rows["Otro"].discount_count) == ("N/A", 0)


def test_stat_lines(spark):
    lines = spark.createDataFrame(
        [
            (
                'x INFO: WORKFLOW_STATS {"item_scraped_count": 142, "elapsed_time_seconds": 87.5, '
                '"responses_per_minute": null, "items_per_minute": 97.5, '
                '"response_status_count/403": 2, "spider": "bbva", "finish_reason": "finished"}',
            ),
            ("x INFO: other",),
            ("WORKFLOW_STATS not json",),
        ],
        "value string",
    )
    rows = metrics.run_stats(lines).collect()
    assert [r.asDict() for r in rows] == [
        {
            "spider": "bbva",
            "items_scraped": 142.0,
            "elapsed_seconds": 87.5,
            "responses_per_minute": None,
            "items_per_minute": 97.5,
            "responses_403": 2.0,
        }
    ]
    assert metrics.long_metrics(metrics.run_stats(lines)).count() == 4


@pytest.mark.parametrize("value,bucket", [(0.5, 0), (1.0, 1), (2.0, 2), (3.9, 2), (2.0**64, 65)])
def test_buckets(one, value, bucket):
    assert one(metrics.bucket_of(F.lit(value))) == bucket


def test_alerts(spark):
    runs = spark.createDataFrame(
        [
            ("2025-01-01 00:00:10", "w", "FAILED"),
            ("2025-01-01 00:00:50", "w", "FAILED"),
            ("2025-01-01 00:01:00", "w", "SUCCEEDED"),
            ("2025-01-01 00:01:30", "v", "FAILED"),
        ],
        "ts string, workflow_id string, status string",
    ).withColumn("ts", F.to_timestamp("ts"))
    rows = {(str(r.window_start), r.workflow_id): r.failures for r in metrics.failure_alerts(runs).collect()}
    assert rows == {("2025-01-01 00:00:00", "w"): 2, ("2025-01-01 00:01:00", "v"): 1}
