from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from test_streaming import plain

from ofertario.operators import dedup, metrics, quality, search
from ofertario.session import written
from ofertario.streaming import distributions

ROWS = [
    (1, 0.5, [0, 6], "a"),
    (1, 2.0, [], "b"),
    (None, None, None, None),
    (3, -1.0, [7, 8, None], "a"),
    (4, 0.2, [1], "b"),
]


@pytest.fixture
def frame(spark):
    rows = spark.createDataFrame(ROWS, "id bigint, rate double, days array<bigint>, kind string")
    return rows.withColumn("a.b", F.lit("own"))


@pytest.fixture
def checks(spark):
    return [
        quality.not_null("id"),
        quality.between("rate", 0, 1),
        quality.elements_between("days"),
        quality.not_empty("days"),
        quality.not_in("kind", ["b"], where=F.col("id") > 1),
        quality.is_true(F.col("rate") < 1, "low"),
    ]


EXPECTED = [
    (1, "a", "unique(id)"),
    (1, "b", "between(rate)"),
    (1, "b", "is_true(low)"),
    (1, "b", "not_empty(days)"),
    (1, "b", "unique(id)"),
    (3, "a", "between(rate)"),
    (3, "a", "elements_between(days)"),
    (4, "b", "not_in(kind)"),
    (None, None, "not_null(id)"),
]


def listed(rows):
    return sorted(((r.id, r.kind, f"{r.check}({r.column})") for r in rows.collect()), key=str)


def test_failing_rows_are_listed(frame, checks):
    rows = quality.failing_rows(frame, [*checks, quality.unique("id")])
    assert listed(rows) == sorted(EXPECTED, key=str)
    assert {r["a.b"] for r in rows.collect()} == {"own"}
    assert quality.failing_rows(frame.where("false"), checks).count() == 0


def test_quarantine_holds_the_rows_and_gives_the_counts(spark, frame, checks, tmp_path):
    path = str(tmp_path / "quarantine")
    report = quality.quarantine(frame, checks, path)
    assert plain(report) == plain(quality.run_checks(frame, checks))
    assert listed(spark.read.parquet(path)) == sorted((e for e in EXPECTED if "unique" not in e[2]), key=str)
    one = spark.read.parquet(path).where("check = 'between'")
    assert one.count() == 2
    assert "PartitionFilters: [isnotnull(check" in one._jdf.queryExecution().executedPlan().toString()


def test_uniqueness_checks_share_a_shuffle(spark, frame):
    checks = [quality.unique("id"), quality.unique("kind"), quality.unique("rate")]
    report = quality.run_checks(frame, checks)
    text = report._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert {r["column"]: (r.failing, r.total) for r in report.collect()} == {"id": (1, 4), "kind": (2, 4), "rate": (0, 4)}
    empty = quality.run_checks(frame.where("false"), checks).collect()
    assert [(r.failing, r.total, r.status) for r in empty] == [(0, 0, "pass")] * 3


def test_rank_by_samples_cuts_one_hour_of_one_key(spark, monkeypatch):
    """A third of all rows in one hour of one key, in no order; a NULL key; ties."""
    draw = random.Random(5)
    rows = [(draw.choice(["a", "b", "c", None]), draw.randrange(10**6), i) for i in range(20_000)]
    rows += [("a", 500_000 + draw.randrange(3600), 20_000 + i) for i in range(10_000)]
    rows += [("d", 7, 30_000 + i) for i in range(3000)]
    draw.shuffle(rows)
    frame = spark.createDataFrame(rows, "k string, at long, id long").repartition(8).withColumn("a.b", F.lit(1))
    held = []
    monkeypatch.setattr(dedup, "written", lambda df, label: held.append(written(df, label)) or held[-1])
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    ranked = dedup.rank_by_samples(frame, ["k"], [F.desc("at"), F.asc("id")])
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert ranked.columns == ["k", "at", "id", "a.b", "rn"]
    expected, seen = {}, {}
    for k, at, i in sorted(rows, key=lambda r: (str(r[0]), -r[1], r[2])):
        seen[k] = seen.get(k, 0) + 1
        expected[i] = seen[k]
    assert {r.id: r.rn for r in ranked.collect()} == expected
    sizes = sorted(r["count"] for r in held[0].groupBy("_part").count().collect())
    assert len(sizes) >= 12 and sizes[-1] < 4 * sizes[len(sizes) // 2]


def test_rank_by_samples_cuts_equal_rows(spark):
    frame = spark.range(5000).select(F.lit("k").alias("k"), F.lit(1).alias("o"))
    ranked = dedup.rank_by_samples(frame, ["k"], [F.asc("o")])
    assert sorted(r.rn for r in ranked.collect()) == list(range(1, 5001))
    assert dedup.rank_by_samples(frame.where("false"), ["k"], [F.asc("o")]).count() == 0


SERVING = (
    "discount_id string, issuer_name string, merchant_name string, merchant_category_name string, "
    "discount_rate double, discount_no_interest_installment_qty bigint, discount_is_active boolean, "
    "discount_valid_days_list array<bigint>, discount_valid_online boolean, discount_valid_instore boolean, "
    "discount_payment_methods_list array<struct<type: string, card_network: string, card_tier: string>>"
)


@pytest.fixture(scope="module")
def offers(spark):
    draw = random.Random(9)
    rows = [
        (
            f"d{i:03}",
            draw.choice(["One", "Two", "Three", None]),
            draw.choice(["Coto", "Disco", "Carrefour", None]),
            draw.choice(["Super", "Bares", None]),
            draw.choice([0.1, 0.2, 0.3, None]),
            draw.choice([3, 6, None]),
            draw.random() < 0.8,
            draw.choice([[0, 1], [5], [], None]),
            draw.choice([True, False, None]),
            draw.choice([True, False]),
            draw.choice([[("credit_card", "visa", "all")], [("debit_card", "all", "all")], [], None]),
        )
        for i in range(300)
    ]
    return spark.createDataFrame(rows, SERVING)


CHOICES = [
    search.Query(merchant="co", issuers=["One", "Two"], days=[1]),
    search.Query(category="Super", issuers=["Three"]),
    search.Query(category="Super"),
    search.Query(issuers=["One"]),
    search.Query(),
]


@pytest.mark.parametrize("query", CHOICES, ids=range(5))
def test_all_facets_in_one_scan(spark, offers, query, tmp_path):
    offers.write.parquet(str(tmp_path / "offers"))
    stored = spark.read.parquet(str(tmp_path / "offers"))
    found = search.all_facets(stored, query)
    expected = [
        (facet, r.value) for facet, values in search.facets(stored, query).items() for r in values.collect()
    ]
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert [tuple(r) for r in found.collect()] == sorted(expected)


@pytest.mark.parametrize("order_by", ["rate", "installments"])
def test_pages_joined_are_the_full_order(offers, order_by):
    query = search.Query(merchant="o", issuers=["One", "Two"], order_by=order_by)
    whole = [r.discount_id for r in search.search(offers, query, limit=None).collect()]
    total = search.result_total(offers, query).first()[0]
    pages, last = [], None
    while page := search.search_after(offers, query, last, limit=7).collect():
        pages += [r.discount_id for r in page]
        last = search.last_of(page, query)
    assert pages == whole and total == len(whole) > 30
    everything = search.Query(**{**vars(query), "include_inactive": True})
    assert search.result_total(offers, everything).first()[0] > total


def test_pages_past_unknown_merchants(spark, offers):
    """Unknown names and rates come last and are paged through, too."""
    query = search.Query(category="Super", issuers=["One", "Two", "Three"], include_inactive=True)
    whole = [r.discount_id for r in search.search(offers, query, limit=None).collect()]
    pages, last = [], None
    while page := search.search_after(offers, query, last, limit=5).collect():
        pages += [r.discount_id for r in page]
        last = search.last_of(page, query)
    assert pages == whole
    assert None in {r.merchant_name for r in search.search(offers, query, limit=None).collect()}


def test_a_running_distribution_closes_its_windows(spark, tmp_path):
    """Batches of an hour each; late values within the lateness count, later ones do not."""
    schema = "ts timestamp, spider string, value double"
    base = spark.createDataFrame([(0,)], "h int").select(F.lit("2025-06-01 00:00:00").cast("timestamp").alias("t"))

    def batch(number: int, *entries) -> None:
        rows = [(minutes, s, v) for minutes, s, v in entries]
        frame = spark.createDataFrame(rows, "m int, spider string, value double").crossJoin(base)
        frame = frame.select((F.col("t") + F.make_interval(mins=F.col("m"))).alias("ts"), "spider", "value")
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run() -> None:
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        counted = distributions.streaming_histogram(stream, ["spider"], lateness="30 minutes", window="1 hour")
        query = counted.writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
        query = query.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()

    batch(0, (5, "x", 3.0), (6, "x", 3.5), (7, "y", 0.1), (8, "x", None))
    run()
    batch(1, (70, "x", 100.0), (50, "x", 9.0))  # the second is late, but not too late
    run()
    batch(2, (200, "x", 5.0))
    run()
    batch(3, (20, "x", 7.0), (400, "y", 1.0))  # the first hour is closed: too late
    run()
    out = spark.read.schema("window_start timestamp, spider string, bucket int, n bigint").parquet(str(tmp_path / "out"))
    values = spark.read.schema(schema).parquet(str(tmp_path / "in"))
    counted = values.where("value <> 7.0 AND ts < timestamp'2025-06-01 04:00:00'")
    assert plain(out) == plain(metrics.windowed_histogram(counted, ["spider"]))
    merged = distributions.merged_histogram(out, ["spider"])
    assert plain(merged) == plain(metrics.histogram(counted, ["spider"]))
