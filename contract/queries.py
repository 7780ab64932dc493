"""The registered queries: every operator over whole supplied tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ofertario.functions import display, jsonx, keys, scalars
from ofertario.operators import category, conform, dedup, issuers, mapping, merge, metrics
from ofertario.operators import name_index, normalize, quality, search, serving, uniqueness
from ofertario.plans import build as plan
from ofertario.session import fresh_folder, written
from ofertario.sources import assemble, keyed, landing, seeds, tables
from ofertario.streaming import alerts, distributions, fact_stream, landing_stream

from .order_offers import orders_by_folder, raw_orders_as, table

TIE = "$.seq"
AS_OF = dt.date(2000, 12, 31)
CUTOFF = dt.date(1999, 6, 30)
SPIDERS = ["bbva", "galicia", "naranjax"]
ODD_NAMES = ["", "ﬁnca ", "½ precio ", "Ǆ ", "𝐁anco 𝟙 ", "Ⅷ ", "İ ", "ß "]
FOUND = search.Query(
    merchant=" furn|mach ", issuers=["Banco BBVA", "Banco Galicia", "Naranja X"]
)
NARROW = search.Query(
    merchant="furn|mach",
    category="Sin categorizar",
    issuers=["Banco BBVA", "Naranja X"],
    days=[1, 4],
)


def _flat(df: DataFrame) -> DataFrame:
    """Lists as texts, so that engines compare them alike; no payloads."""
    listed = {"days": "valid_days_list", "methods": "payment_methods_list"}
    for name, column in listed.items():
        for full in (f"discount_{column}", column):
            if full in df.columns:
                text = keys.number_list_text if name == "days" else keys.struct_list_text
                df = df.withColumn(name, text(full)).drop(full)
    if "record_order" in df.columns:
        df = df.withColumn("seq", F.col("record_order.tie")).drop("record_order", "discount_metadata")
    if "discount_metadata" in df.columns:
        seq = F.try_variant_get("discount_metadata", TIE, "bigint")
        df = df.withColumn("seq", seq).drop("discount_metadata")
    return df


_made: dict[tuple, str] = {}


def _once(spark, sf, label: str, make: Callable[[str], None]) -> str:
    """The folder ``make`` filled, made once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf, label)
    if key not in _made:
        path = fresh_folder(spark, label)
        make(path)
        _made[key] = path
    return _made[key]


def _landed(spark, sf) -> str:
    """The orders as JSON lines, one folder per source and month."""

    def land(path: str) -> None:
        landing.write_landing(orders_by_folder(spark, sf), path)

    return _once(spark, sf, "landing", land)


def _raw(spark, sf) -> DataFrame:
    return landing.usable(landing.read_landing(spark, _landed(spark, sf), spider=SPIDERS))


def _published(spark, sf) -> DataFrame:
    """The serving table as the search reads it, from its files."""

    def publish(path: str) -> None:
        tables.write_table(_serving(spark, sf), path)

    return serving.load_discounts(spark, _once(spark, sf, "published", publish))


def _staged(spark, sf) -> DataFrame:
    return plan.staged(_raw(spark, sf))


def _kept(spark, sf) -> DataFrame:
    return conform.keep_worth_showing(_staged(spark, sf))


def _deduped(spark, sf) -> DataFrame:
    return dedup.dedup_by_source(_kept(spark, sf), TIE)


def _category_seeds(spark) -> tuple[DataFrame, DataFrame]:
    overrides = seeds.values_frame(
        spark, ["merchant_name", "normalized_category"], [("Furniture", "Hogar y decoración")]
    )
    categories = seeds.values_frame(
        spark,
        ["issuer", "raw_merchant_category_name", "parsed_merchant_category_name"],
        [("banco bbva", "Asia", "Viajes"), ("NARANJA X", "Europe", "Otros")],
    )
    return overrides, categories


def _normalised(spark, sf) -> DataFrame:
    return plan.normalised(_deduped(spark, sf), *_category_seeds(spark))


def _fact(spark, sf) -> DataFrame:
    return merge.fact_columns(_normalised(spark, sf))


def _serving(spark, sf) -> DataFrame:
    return serving.serving_table(_fact(spark, sf), AS_OF)


# --- landing zone, tables, seeds -------------------------------------------


def s1_read_landing(spark, sf):
    raw = _raw(spark, sf)
    named = F.coalesce(
        jsonx.json_value("raw_payload", "$.source_id"), jsonx.json_value("raw_payload", "$.id")
    )
    return raw.select(
        "spider",
        "scraped_at_dt",
        named.alias("source_id"),
        F.try_variant_get("raw_payload", TIE, "bigint").alias("seq"),
    )


def s2_write_landing(spark, sf):
    path = fresh_folder(spark, "landing")
    landing.write_landing(orders_by_folder(spark, sf), path)
    raw = landing.read_landing(spark, path, spider=SPIDERS)
    return raw.groupBy("spider", "scraped_at_dt").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(F.try_variant_get("raw_payload", TIE, "bigint")).alias("seq_total"),
    )


def s3_read_seed(spark, sf):
    part = table(spark, sf, "part")
    kind = F.when(F.col("p_size") > 25, "grande").otherwise("chico")
    path = fresh_folder(spark, "seed")
    part.select(
        kind.alias("issuer"),
        F.col("p_type").alias("raw_merchant_category_name"),
        F.concat_ws(" ", kind, F.lower("p_type")).alias("parsed_merchant_category_name"),
    ).distinct().write.option("header", True).csv(path)
    seed = seeds.read_seed(spark, "merchant_categories", path)
    counted = part.groupBy("p_type", "p_brand", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("parts")
    )
    return category.lookup_chain(
        counted,
        "category",
        [
            (
                seed,
                [("kind", "issuer"), ("p_type", "raw_merchant_category_name")],
                "parsed_merchant_category_name",
            )
        ],
        "none",
    )


def _responses(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").withColumn("scraped_at_dt", F.to_date("o_orderdate"))


def _body(**fields) -> Column:
    return F.parse_json(
        F.to_json(F.struct(*[v.alias(k) for k, v in fields.items()]), {"ignoreNullFields": "false"})
    ).alias("body")


def s4_assemble_bbva(spark, sf):
    orders = _responses(spark, sf)
    key = F.col("o_orderkey")
    starts = F.when(F.col("o_orderstatus") != "P", F.lit("1995-01-01"))
    entry = F.struct(
        key.alias("id"),
        starts.alias("fechaDesde"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fechaHasta"),
        F.lit("de catalogo").alias("subcabecera"),
    )
    blank = F.struct(
        F.lit(None).cast("bigint").alias("id"),
        starts.alias("fechaDesde"),
        F.lit("").alias("fechaHasta"),
        F.lit("").alias("subcabecera"),
    )
    catalogue = orders.select(
        F.col("o_orderpriority").alias("category_name"),
        "scraped_at_dt",
        _body(message=F.lit("paginas: 1"), data=F.array(entry, blank)),
    )
    detail = F.struct(
        F.col("o_custkey").alias("customer"),
        F.concat(F.lit("de detalle "), "o_orderstatus").alias("subcabecera"),
    )
    details = orders.select(key.cast("string").alias("id"), "scraped_at_dt", _body(data=detail))
    items = assemble.assemble_bbva(catalogue, details)
    p = "raw_payload"
    return items.select(
        jsonx.json_value(p, "$.source_id").alias("source_id"),
        jsonx.json_value(p, "$.subcabecera").alias("subcabecera"),
        jsonx.json_value(p, "$.category_name").alias("category_name"),
        jsonx.json_value(p, "$.discount_start_date").alias("discount_start_date"),
        jsonx.json_value(p, "$.discount_end_date").alias("discount_end_date"),
        jsonx.json_value(p, "$.customer").alias("customer"),
        (~F.is_variant_null(jsonx.json_query(p, "$.discount_start_date"))).alias("has_start_value"),
    )


def s4_assemble_galicia(spark, sf):
    orders = _responses(spark, sf)
    key = F.col("o_orderkey")
    listed = F.struct(F.array(F.struct(key.alias("id"))).alias("list"))
    catalogue = orders.select("scraped_at_dt", _body(data=listed))
    details = orders.select(
        key.cast("string").alias("id"),
        "scraped_at_dt",
        _body(data=F.struct(F.col("o_custkey").alias("customer"))),
    )
    items = assemble.assemble_galicia(catalogue, details)
    return items.select(
        jsonx.json_value("raw_payload", "$.source_id").alias("source_id"),
        jsonx.json_value("raw_payload", "$.customer").alias("customer"),
    )


def s4_assemble_naranjax(spark, sf):
    orders = _responses(spark, sf)
    key = F.col("o_orderkey").cast("string")
    commerce = F.concat(F.lit("c"), key)
    entry = F.struct(
        commerce.alias("url"),
        F.when(F.col("o_orderstatus") == "F", "uno").alias("urlDetail"),
        F.concat(F.lit("https://x/"), key).alias("fullUrl"),
    )
    catalogue = orders.select("scraped_at_dt", _body(data=F.array(entry)))
    near = F.array(F.struct(F.lit("uno").alias("url")), F.struct(F.lit("dos").alias("url")))
    commerces = orders.select(
        commerce.alias("commerce"), "scraped_at_dt", F.lit(200).alias("status"), _body(nearCurrent=near)
    )
    planned = orders.withColumn("plan", F.explode(F.array(F.lit("uno"), F.lit("dos"))))
    failed = (F.col("o_orderpriority") == "5-LOW") & (F.col("plan") == "dos")
    details = planned.select(
        commerce.alias("commerce"),
        "plan",
        "scraped_at_dt",
        F.when(failed, 403).otherwise(200).alias("status"),
        _body(customer=F.col("o_custkey")),
    )
    items = assemble.assemble_naranjax(catalogue, commerces, details)
    return items.select(
        jsonx.json_value("raw_payload", "$.id").alias("id"),
        jsonx.json_value("raw_payload", "$.discount_url").alias("discount_url"),
        jsonx.json_value("raw_payload", "$.customer").alias("customer"),
    )


def s4_page_counts(spark, sf):
    entries = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(
        F.count(F.lit(1)).alias("entries")
    )
    message = F.concat(F.lit("Total paginas: "), F.col("entries").cast("string"))
    return entries.select(
        "priority",
        "entries",
        assemble.page_count_of(F.col("entries"), F.lit(7)).alias("pages"),
        assemble.page_count_in(message).alias("told"),
    )


def s5_new_files(spark, sf):
    """Two files land in each source; those from before the run do not count."""
    path = fresh_folder(spark, "arrivals")
    rows = orders_by_folder(spark, sf).withColumn("scraped_at_dt", F.to_date(F.lit("2000-01-01")))
    landing.write_landing(rows, path, files_per_folder=1)
    landing.write_landing(rows, path, files_per_folder=1)
    early, late = dt.datetime(2000, 1, 1), dt.datetime(2200, 1, 1)
    now = landing.new_files(spark, path, early)
    later = landing.new_files(spark, path, late).withColumnRenamed("new_files", "later_files")
    return now.join(later, "spider", "left").select(
        "spider", "new_files", F.coalesce("later_files", F.lit(0)).alias("later_files")
    )


def s5_file_ledger(spark, sf):
    """One file a source and month; then one more for months from 2000 on. The second
    call lists those months only and takes what the first did not."""
    path, ledger = fresh_folder(spark, "arrivals"), fresh_folder(spark, "ledger")
    rows = orders_by_folder(spark, sf, whole=True)
    months = [r[0] for r in rows.select("scraped_at_dt").distinct().collect()]
    late = [m for m in months if m >= dt.date(2000, 1, 1)]
    landing.write_landing(rows, path)
    first = landing.take_new_files(spark, path, ledger, months)
    landing.write_landing(rows.filter(F.col("scraped_at_dt").isin(late)), path)
    second = landing.take_new_files(spark, path, ledger, late)
    runs = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return runs.select("run", "spider", "scraped_at_dt", "new_files")


def s6_write_table(spark, sf):
    """A reader keeps its version while the next one is staged, and sees only what is committed."""
    path = fresh_folder(spark, "serving")
    rows = _serving(spark, sf)
    tables.write_version(rows, path, keep=2)
    reader = tables.read_version(spark, path)
    tables.stage_version(rows.limit(0), path)
    return _flat(reader.unionByName(tables.read_version(spark, path).limit(0)))


def s7_load_discounts(spark, sf):
    return _flat(_published(spark, sf))


def s7_load_issuers(spark, sf):
    path = fresh_folder(spark, "issuers")
    tables.write_table(serving.issuer_summary(_fact(spark, sf)), path)
    return serving.load_issuers(spark, path)


# --- JSON access -----------------------------------------------------------


def _props(spark, sf) -> DataFrame:
    """Event properties as VARIANT, and a payload with nested and null parts."""
    inner = F.struct(F.col("event_id").alias("n"))
    rich = F.struct(
        F.col("event_type").alias("label"),
        inner.alias("inner"),
        F.lit("{user}").alias("bracketed"),
        F.lit(None).cast("string").alias("nothing"),
    )
    text = F.to_json(rich, {"ignoreNullFields": "false"})
    return table(spark, sf, "events").select(
        "event_id", "event_type", F.parse_json("props").alias("props"), F.parse_json(text).alias("rich")
    )


def j1_json_value(spark, sf):
    return _props(spark, sf).select(
        "event_id",
        jsonx.json_value("props", "$.k").alias("k"),
        jsonx.json_value("props", "$.z").alias("missing"),
        jsonx.json_value("props", "$").alias("whole"),
        jsonx.json_value("rich", "$.label").alias("label"),
        jsonx.json_value("rich", "$.inner").alias("inner_object"),
        jsonx.json_value("rich", "$.bracketed").alias("bracketed"),
    )


def j1_stored_payloads(spark, sf):
    """Typed paths of all landed records, from shredded payloads."""
    path = _once(spark, sf, "payloads", lambda folder: landing.store_payloads(_raw(spark, sf), folder))
    stored = landing.read_payloads(spark, path)
    seq = F.try_variant_get("raw_payload", TIE, "bigint")
    return stored.select("spider", "scraped_at_dt", seq.alias("seq"))


def j2_json_query(spark, sf):
    return _props(spark, sf).select(
        "event_id",
        F.to_json(jsonx.json_query("props", "$")).alias("subtree"),
        jsonx.json_query("props", "$.k").cast("bigint").alias("k"),
    )


def j3_json_array(spark, sf):
    raw = raw_orders_as(spark, sf, "naranjax")
    return raw.select(
        F.try_variant_get("raw_payload", TIE, "bigint").alias("seq"),
        F.array_size(jsonx.json_array("raw_payload", "$.paymentMethods")).alias("methods"),
        jsonx.json_array_size("raw_payload", "$.commerces").alias("commerces"),
        jsonx.json_array_size("raw_payload", "$.nothing").alias("missing"),
    )


def j4_json_value_array(spark, sf):
    raw = raw_orders_as(spark, sf, "naranjax")
    mixed = F.parse_json(F.to_json(F.struct(F.array(F.struct("spider")).alias("a"))))
    return raw.select(
        F.try_variant_get("raw_payload", TIE, "bigint").alias("seq"),
        F.array_join(jsonx.json_value_array("raw_payload", "$.paymentMethods"), ",").alias("methods"),
        F.array_join(
            jsonx.json_value_array("raw_payload", "$.days.weekdaysApplied"), ","
        ).alias("weekdays"),
        jsonx.json_value_array(mixed, "$.a").isNull().alias("mixed_is_null"),
    )


def j5_json_text(spark, sf):
    entry = F.struct(F.col("event_type").alias("type"), F.lit(None).cast("string").alias("tier"))
    return _props(spark, sf).select(
        "event_id",
        jsonx.json_text("props").alias("text"),
        jsonx.struct_text(entry).alias("struct_text"),
    )


def j6_has_keys(spark, sf):
    events = table(spark, sf, "events")
    inner = F.when(F.col("event_type") != "error", F.struct(F.col("value").alias("v")))
    some = F.parse_json(F.to_json(F.struct(F.col("user_id").alias("u"), inner.alias("inner"))))
    with_some = events.select("event_id", some.alias("some"))
    return _props(spark, sf).join(with_some, "event_id").select(
        "event_id",
        jsonx.has_key("props", "$.k").alias("has_k"),
        jsonx.has_key("props", "$.z").alias("has_z"),
        jsonx.has_keys("props", ["k", "z"], "or").alias("any_of"),
        jsonx.has_keys("props", ["k", "z"]).alias("all_of"),
        jsonx.has_key("rich", "$.nothing").alias("has_null"),
        jsonx.has_keys("some", ["u", "inner.v"]).alias("has_inner"),
    )


def j7_array_index(spark, sf):
    return raw_orders_as(spark, sf, "bbva").select(
        F.try_variant_get("raw_payload", TIE, "bigint").alias("seq"),
        jsonx.json_value("raw_payload", "$.beneficios[0].tope").alias("cap"),
        jsonx.json_value("raw_payload", "$.beneficios[0].cuota").alias("installments"),
    )


# --- normalisation, union, filters -----------------------------------------


def p1_normalize_bbva(spark, sf):
    return _flat(normalize.normalize_bbva(raw_orders_as(spark, sf, "bbva")))


def p2_normalize_galicia(spark, sf):
    return _flat(normalize.normalize_galicia(raw_orders_as(spark, sf, "galicia")))


def p3_normalize_naranjax(spark, sf):
    return _flat(normalize.normalize_naranjax(raw_orders_as(spark, sf, "naranjax")))


def p4_rename(spark, sf):
    return _flat(_kept(spark, sf)).select("issuer_name", "last_updated_at_date", "seq")


def p5_fact_columns(spark, sf):
    return _flat(_fact(spark, sf))


def p6_serving_table(spark, sf):
    return _flat(_serving(spark, sf))


def u1_union_sources(spark, sf):
    return _flat(_staged(spark, sf)).withColumnRenamed("last_updated_at_date", "scraped_at_dt")


def f1_worth_showing(spark, sf):
    return _flat(_kept(spark, sf))


def f2_required_keys(spark, sf):
    late = F.when(F.col("o_orderstatus") != "F", F.struct(F.col("o_custkey").alias("x")))
    even = F.when(F.col("o_orderkey") % 2 == 0, F.lit(1))
    payload = F.parse_json(
        F.to_json(F.struct("o_orderkey", late.alias("d"), even.alias("even")))
    )
    return table(spark, sf, "orders").select("o_orderkey", payload.alias("payload")).select(
        "o_orderkey",
        jsonx.has_keys("payload", ["o_orderkey", "d", "d.x"]).alias("kept_by_all"),
        jsonx.has_keys("payload", ["d.x", "even"], "or").alias("kept_by_any"),
    )


def f3_partition_filter(spark, sf):
    raw = landing.read_landing(spark, _landed(spark, sf), spider="galicia")
    return raw.groupBy("scraped_at_dt").agg(F.count(F.lit(1)).alias("records"))


def _dated_orders(spark, sf) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.to_date("o_orderdate").alias("last_updated_at_date"),
    )


def f4_newer_than(spark, sf):
    orders = _dated_orders(spark, sf)
    target = merge.up_to(orders.filter("o_orderstatus = 'F'"), CUTOFF)
    return merge.newer_than(orders, target).drop("o_orderstatus")


def f5_up_to(spark, sf):
    return merge.up_to(_dated_orders(spark, sf), CUTOFF).drop("o_orderstatus")


# --- joins -----------------------------------------------------------------


def n1_resolve_category(spark, sf):
    return _normalised(spark, sf).select("discount_id", "merchant_name", "merchant_category_clean")


def n1_lookup_chain(spark, sf):
    customer = table(spark, sf, "customer")
    nation = table(spark, sf, "nation")
    named = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left").select(
        "c_custkey", "c_mktsegment", "n_name", "n_regionkey"
    )
    overrides = seeds.values_frame(
        spark, ["segment", "kind"], [("Building", "obra"), ("MACHINERY", "obra")]
    )
    pairs = named.filter("n_regionkey < 3").select(
        F.lower("n_name").alias("nation"),
        "c_mktsegment",
        F.concat_ws("/", "n_name", F.lower("c_mktsegment")).alias("path"),
    ).distinct()
    return category.lookup_chain(
        named,
        "category",
        [
            (overrides, [("c_mktsegment", "segment")], "kind"),
            (pairs, [("n_name", "nation"), ("c_mktsegment", "c_mktsegment")], "path"),
        ],
        "otros",
    ).select("c_custkey", "category")


def _joined_entries(column: str | Column) -> Column:
    return F.array_join(
        F.transform(column, lambda e: F.concat_ws(":", F.coalesce(e["a"], F.lit("?")), F.coalesce(e["b"], F.lit("?")))),
        ",",
    )


def n2_map_elements(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    dim = [
        ("red", "color", "rojo"),
        ("blue", "color", "azul"),
        ("old", "edad", "viejo"),
        ("ring", "pieza", "aro"),
        ("gear", "pieza", "rueda"),
    ]
    mapped = mapping.map_elements(
        parts, "mapped", "words", lambda w: [w], dim, ["word"], ["a", "b"], ["a", "b"]
    )
    return mapped.select("p_partkey", _joined_entries("mapped").alias("words"))


def n2_map_elements_join(spark, sf):
    key = F.col("o_custkey")
    orders = table(spark, sf, "orders").select("o_orderkey", F.array(key, key + 1).alias("customers"))
    dim = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    mapped = mapping.map_elements(
        orders,
        "mapped",
        "customers",
        lambda c: [c],
        dim,
        ["c_custkey"],
        ["c_mktsegment"],
        ["segment"],
    )
    texts = F.transform("mapped", lambda e: F.coalesce(e["segment"], F.lit("?")))
    return mapped.select("o_orderkey", F.array_join(texts, ",").alias("segments"))


def n3_map_value(spark, sf):
    dim = [("1-URGENT", "alta", "1"), ("1-URGENT", "maxima", "1"), ("2-HIGH", "alta", "2")]
    mapped = mapping.map_value(
        table(spark, sf, "orders"),
        "levels",
        [F.col("o_orderpriority")],
        dim,
        ["priority"],
        ["a", "b"],
        ["a", "b"],
    )
    return mapped.select("o_orderkey", _joined_entries("levels").alias("levels"))


def n3_map_value_join(spark, sf):
    mapped = mapping.map_value(
        table(spark, sf, "orders"),
        "matches",
        [F.col("o_custkey")],
        table(spark, sf, "customer"),
        ["c_custkey"],
        ["c_mktsegment"],
        ["segment"],
    )
    texts = F.transform("matches", lambda e: e["segment"])
    return mapped.select("o_orderkey", F.array_join(texts, ",").alias("matches"))


def _parts_dim(spark, sf, most: int | None) -> DataFrame:
    """Part names by number, of the first ``most`` parts or all: below or above the inline limit."""
    part = table(spark, sf, "part").select((F.col("p_partkey") % 500).alias("k"), "p_name", "p_brand")
    return part if most is None else part.filter(F.col("k") < most).filter(F.col("p_brand") < "Brand#2")


def _sizes(spark, sf, mapped: Callable[[DataFrame], DataFrame]) -> DataFrame:
    small, large = (mapped(_parts_dim(spark, sf, most)) for most in (30, None))
    return small.withColumn("dim", F.lit("small")).unionByName(large.withColumn("dim", F.lit("large")))


def n2_map_elements_sizes(spark, sf):
    """One result whatever the size of the dimension; keys repeat in both."""
    key = F.col("o_custkey") % 40
    orders = table(spark, sf, "orders").select("o_orderkey", F.array(key, key + 1, F.lit(7)).alias("ks"))

    def mapped(dim):
        df = mapping.map_elements(
            orders, "entries", "ks", lambda k: [k], dim, ["k"], ["p_brand", "p_name"], ["a", "b"], shown=_joined_entries
        )
        return df.select("o_orderkey", "entries")

    return _sizes(spark, sf, mapped)


def n3_map_value_sizes(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") % 40).alias("k"))

    def mapped(dim):
        df = mapping.map_value(
            orders, "entries", [F.col("k")], dim, ["k"], ["p_brand", "p_name"], ["a", "b"], shown=_joined_entries
        )
        return df.select("o_orderkey", "entries")

    return _sizes(spark, sf, mapped)


def a2_regroup_elements(spark, sf):
    """Elements without a match come back as structs of NULLs, in their places."""
    words = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    dim = table(spark, sf, "customer").select(F.lit("no such word").alias("k"), "c_mktsegment")
    mapped = mapping.map_elements(words, "m", "words", lambda w: [w], dim, ["k"], ["c_mktsegment"], ["a"])
    return mapped.select(
        "p_partkey",
        F.size("m").alias("entries"),
        F.size(F.filter("m", lambda e: e.isNotNull() & e["a"].isNull())).alias("without_value"),
    )


def n6_explode_days(spark, sf):
    return (
        _staged(spark, sf)
        .select("issuer_name", F.explode("discount_valid_days_list").alias("day"))
        .groupBy("issuer_name", "day")
        .agg(F.count(F.lit(1)).alias("offers"))
    )


# --- aggregations ----------------------------------------------------------


def _event_fact(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select(
        F.col("event_type").alias("issuer_name"), F.to_date("ts").alias("last_updated_at_date")
    )


def a1_issuer_summary(spark, sf):
    return serving.issuer_summary(_event_fact(spark, sf))


def a3_basis_points(spark, sf):
    cheap = F.col("l_discount") < 0.1
    return quality.run_checks(table(spark, sf, "lineitem"), [quality.is_true_share(cheap, "cheap")])


def a4_reconcile(spark, sf):
    fact = _event_fact(spark, sf)
    extra = fact.agg(
        F.lit(None).cast("string").alias("issuer_name"),
        F.max("last_updated_at_date").alias("last_updated_at_date"),
    )
    return quality.reconcile(fact.unionByName(extra), serving.issuer_summary(fact))


def a5_watermark(spark, sf):
    return _dated_orders(spark, sf).agg(F.max("last_updated_at_date").alias("newest"))


def a6_totals(spark, sf):
    totals = serving.summary_totals(serving.issuer_summary(_fact(spark, sf)))
    counts = serving.result_counts(_published(spark, sf))
    return totals.withColumn("active_discounts", counts.select("active_discounts").scalar())


def a7_items_per_category(spark, sf):
    raw = _raw(spark, sf)
    p = "raw_payload"
    named = F.coalesce(
        jsonx.json_value(p, "$.category_name"),
        jsonx.json_value(p, "$.marca.categoria.descripcion"),
        jsonx.json_value(p, "$.category.name"),
    )
    return metrics.items_per_category(raw, named)


# --- windows ---------------------------------------------------------------


def w1_latest_by(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts")
    return dedup.latest_by(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


def w1_dedup_by_source(spark, sf):
    return _flat(_deduped(spark, sf))


def w2_rank_within(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    hour = F.date_trunc("hour", "ts")
    return dedup.rank_within(
        events, ["event_type"], [F.desc("ts"), F.asc("event_id")], [(hour, True)]
    ).drop("ts")


def w2_rank_by_samples(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    ranked = dedup.rank_by_samples(events, ["event_type"], [F.desc("ts"), F.asc("event_id")])
    return ranked.drop("ts")


def w2_dedup_audit(spark, sf):
    deduped = written(_deduped(spark, sf).drop("discount_metadata", "record_order"), "deduped")
    return dedup.dedup_audit(deduped).select(
        "discount_id", "discount_content_hash", "last_updated_at_date", "rn"
    )


def w3_dedup_by_content(spark, sf):
    return dedup.dedup_by_content(_deduped(spark, sf)).select(
        "discount_id", "discount_content_hash", "last_updated_at_date"
    )


# --- keys, order, pages ----------------------------------------------------


def k1_surrogate_key(spark, sf):
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        keys.surrogate_key("o_orderkey", known, F.to_date("o_orderdate")).alias("key"),
    )


def k2_list_text(spark, sf):
    def entry(code: str) -> Column:
        return F.struct(F.col(code).alias("code"), F.lit(None).cast("string").alias("note"))

    numbers = F.array(F.col("l_linenumber").cast("bigint"), F.col("l_suppkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        keys.number_list_text(numbers).alias("numbers"),
        keys.struct_list_text(F.array(entry("l_returnflag"), entry("l_linestatus"))).alias("structs"),
    )


def k3_content_hash(spark, sf):
    return dedup.with_content_hash(_deduped(spark, sf)).select("discount_id", "discount_content_hash")


def _positions(df: DataFrame, columns: list[str]) -> DataFrame:
    """An ordered frame with the place of each row: rows of earlier partitions come before."""
    placed = written(
        df.select(*columns)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id() % F.lit(1 << 33)),
        "ordered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    return placed.join(starts, "_part").select(*columns, (F.col("_start") + F.col("_at") + 1).alias("position"))


def l1_order(spark, sf):
    ordered = search.ordered(_published(spark, sf), FOUND)
    return _positions(ordered, ["discount_id", "discount_rate", "merchant_name"])


def l2_page(spark, sf):
    page = search.search(_published(spark, sf), FOUND, limit=20, offset=20)
    return page.select("discount_id", "discount_rate", "merchant_name")


def l2_next_pages(spark, sf):
    """Three pages, each sought behind the last row of the one before, with the total."""
    offers, last, pages = _published(spark, sf), None, []
    total = search.result_total(offers, FOUND).scalar()
    for number in range(1, 4):
        page = search.search_after(offers, FOUND, last).withColumn("page", F.lit(number))
        pages.append(page.withColumn("total", total))
        last = search.last_of(page.collect(), FOUND) or last
    rows = pages[0].unionByName(pages[1]).unionByName(pages[2])
    return rows.select("page", "discount_id", "discount_rate", "merchant_name", "total")


def l3_order_issuers(spark, sf):
    ordered = serving.issuer_summary(_fact(spark, sf)).orderBy("issuer_name")
    return _positions(ordered, ordered.columns)


# --- incremental merge -----------------------------------------------------


def _order_rows(spark, sf) -> DataFrame:
    return _dated_orders(spark, sf).withColumnRenamed("o_custkey", "id")


def _newest_orders(df: DataFrame) -> DataFrame:
    return dedup.latest_by(df, ["id"], [F.desc("last_updated_at_date"), F.desc("o_orderkey")])


def m1_upsert(spark, sf):
    rows = _order_rows(spark, sf)
    target = _newest_orders(merge.up_to(rows, CUTOFF))
    incoming = _newest_orders(merge.newer_than(rows, target))
    return merge.upsert(target, incoming)


def m1_versions(spark, sf):
    rows = _order_rows(spark, sf)
    path = fresh_folder(spark, "versions")
    tables.write_version(_newest_orders(merge.up_to(rows, CUTOFF)), path, "full")
    target = tables.read_version(spark, path)
    incoming = _newest_orders(merge.newer_than(rows, target))
    tables.write_version(merge.upsert(target, incoming), path, "incremental")
    return tables.read_version(spark, path)


def m1_upsert_buckets(spark, sf):
    """A full load, then an increment that rewrites the buckets of its ids only."""
    rows, path = _order_rows(spark, sf), fresh_folder(spark, "keyed")
    keyed.upsert_keyed(_newest_orders(merge.up_to(rows, CUTOFF)), path, "id", 16)
    target = keyed.read_keyed(spark, path, rows.schema, 16)
    keyed.upsert_keyed(_newest_orders(merge.newer_than(rows, target)), path, "id", 16)
    return keyed.read_keyed(spark, path, rows.schema, 16)


# --- checks ----------------------------------------------------------------


def t1_not_null(spark, sf):
    known = F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
    return quality.run_checks(
        table(spark, sf, "lineitem").withColumn("flag", known),
        [quality.not_null("l_shipdate"), quality.not_null("flag")],
    )


def t2_unique(spark, sf):
    return quality.run_checks(
        table(spark, sf, "orders"), [quality.unique("o_orderkey"), quality.unique("o_custkey")]
    )


def t3_between(spark, sf):
    return quality.run_checks(
        table(spark, sf, "lineitem"),
        [quality.between("l_discount", 0.02, 0.09), quality.between("l_tax", 0.0)],
    )


def _gives() -> Column:
    return (F.col("l_discount") != 0) | (F.col("l_tax") != 0)


def t4_is_true(spark, sf):
    return quality.run_checks(table(spark, sf, "lineitem"), [quality.is_true(_gives(), "gives")])


def t5_is_true_share(spark, sf):
    known = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag") != "R")
    return quality.run_checks(
        table(spark, sf, "lineitem"),
        [quality.is_true_share(_gives(), "gives"), quality.is_true_share(known, "known")],
    )


def t6_elements_between(spark, sf):
    line = F.col("l_linenumber")
    return quality.run_checks(
        table(spark, sf, "lineitem").withColumn("sizes", F.array(line - 2, line, F.lit(None))),
        [quality.elements_between("sizes")],
    )


def t7_not_empty(spark, sf):
    empty = F.array().cast("array<string>")
    methods = F.when(F.col("l_returnflag") == "A", empty).when(
        F.col("l_returnflag") == "R", F.array("l_returnflag")
    )
    return quality.run_checks(
        table(spark, sf, "lineitem").withColumn("methods", methods), [quality.not_empty("methods")]
    )


def t8_not_in(spark, sf):
    return quality.run_checks(
        table(spark, sf, "orders"), [quality.not_in("o_orderpriority", ["5-LOW", "1-URGENT"])]
    )


def t9_required_keys(spark, sf):
    status = F.when(F.col("o_orderstatus") != "F", F.struct(F.col("o_custkey").alias("x")))
    payload = F.parse_json(F.to_json(F.struct("o_orderkey", status.alias("d"))))
    rows = table(spark, sf, "orders").withColumn("payload", payload)
    check = quality.has_required_keys(
        "payload", ["o_orderkey", "d.x"], where=F.col("o_orderpriority") != "5-LOW"
    )
    return quality.run_checks(rows, [check])


def t9_null_payloads(spark, sf):
    """JSON nulls lack every key; unread lines are counted apart."""
    orders, path = table(spark, sf, "orders"), fresh_folder(spark, "nulls")
    line = (
        F.when(F.col("o_orderkey") % 10 == 0, '{"raw_payload": null}')
        .when(F.col("o_orderkey") % 10 == 1, "not json")
        .otherwise(F.format_string('{"raw_payload": {"source_id": %d}}', "o_orderkey"))
    )
    orders.select(line.alias("value")).write.text(f"{path}/spider=bbva/scraped_at_dt=2000-01-01")
    raw = landing.read_landing(spark, path, spider=["bbva"])
    return quality.run_checks(
        raw,
        [
            quality.has_required_keys("raw_payload", ["source_id"]),
            quality.has_payload("raw_payload", error=9),
        ],
    )


def _line_checks() -> tuple[list[quality.Check], Column]:
    numbers = F.array(F.col("l_linenumber").cast("bigint") - 2, F.col("l_linenumber").cast("bigint"))
    checks = [
        quality.not_null("flag"),
        quality.between("l_discount", 0.02, 0.09),
        quality.is_true(_gives(), "gives"),
        quality.elements_between("numbers"),
        quality.not_in("l_linestatus", ["F"]),
        quality.not_empty("methods", where=F.col("l_linenumber") > 1),
    ]
    return checks, numbers


def _checked_lines(spark, sf) -> tuple[DataFrame, list[quality.Check]]:
    checks, numbers = _line_checks()
    flag = F.when(F.col("l_returnflag") != "R", F.col("l_returnflag"))
    methods = F.when(F.col("l_returnflag") == "A", F.array().cast("array<string>")).otherwise(F.array("l_linestatus"))
    lines = table(spark, sf, "lineitem").withColumns({"flag": flag, "numbers": numbers, "methods": methods})
    return lines, checks


def t_failing_rows(spark, sf):
    """Every line once for each check that it fails."""
    lines, checks = _checked_lines(spark, sf)
    failing = quality.failing_rows(lines, [*checks, quality.unique("l_orderkey")])
    return failing.select("l_orderkey", "l_linenumber", "check", "column")


def t_quarantine(spark, sf):
    """The lines that fail row checks, as the quarantine holds them."""
    lines, checks = _checked_lines(spark, sf)
    path = fresh_folder(spark, "quarantine")
    quality.quarantine(lines, checks, path)
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "check", "column")


def t_quarantine_report(spark, sf):
    """The counts that the quarantine's own pass gives."""
    lines, checks = _checked_lines(spark, sf)
    return quality.quarantine(lines, checks, fresh_folder(spark, "quarantine"))


def t2_unique_increments(spark, sf):
    """Three increments of orders, each held against the digests of those before."""
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    name = f"key_index_{uuid.uuid4().hex}"
    index = uniqueness.KeyIndex(spark, fresh_folder(spark, "digests"), name, 8)
    reports = []
    for number, (low, high) in enumerate([(None, 1997), (1997, 1999), (1999, None)]):
        own = orders
        if low is not None:
            own = own.filter(F.year("day") >= low)
        if high is not None:
            own = own.filter(F.year("day") < high)
        report = uniqueness.check_increment(own, ["o_orderkey", "o_custkey"], index, str(number))
        reports.append(report.withColumn("increment", F.lit(number)))
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


def t10_reconcile(spark, sf):
    fact = _fact(spark, sf)
    return quality.reconcile(fact, serving.issuer_summary(fact)).select(
        F.col("fact_count").cast("int"), F.col("summary_count").cast("int")
    )


def t11_severity(spark, sf):
    metric = F.count_if(F.col("l_tax") == 0).alias("metric")
    counted = table(spark, sf, "lineitem").groupBy(F.col("l_linenumber").alias("line")).agg(metric)
    return counted.withColumn("status", F.expr(quality.severity("metric", 500, 900)))


def t_staging_checks(spark, sf):
    staged = normalize.normalize_galicia(raw_orders_as(spark, sf, "galicia"))
    return quality.run_checks(staged, quality.staging_checks())


# --- search ----------------------------------------------------------------


def q1_text(spark, sf):
    return search.prefiltered(_published(spark, sf), FOUND).select("discount_id", "merchant_name")


def q1_text_indexed(spark, sf):
    """The same rows by way of the name index, from files in the order of names."""

    def publish(path: str) -> None:
        by_name = _published(spark, sf).repartitionByRange("merchant_name", "discount_id")
        by_name.sortWithinPartitions("merchant_name", "discount_id").write.parquet(f"{path}/offers")
        name_index.write_name_index(_published(spark, sf), f"{path}/index")

    path = _once(spark, sf, "by-name", publish)
    offers = spark.read.parquet(f"{path}/offers")
    return name_index.by_name(offers, f"{path}/index", FOUND).select("discount_id", "merchant_name")


def q1_text_literal(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        "p_name",
        search.text_matches("p_name", "RED W", literal=True).alias("literal"),
        search.text_matches("p_name", "^(RED|old) .*e").alias("pattern"),
    )


def q2_category(spark, sf):
    query = search.Query(category="Hogar y decoración")
    return search.prefiltered(_published(spark, sf), query).select("discount_id")


def q3_no_choice(spark, sf):
    unasked = search.search(_published(spark, sf), search.Query(issuers=FOUND.issuers))
    no_issuer = search.search(_published(spark, sf), search.Query(merchant="furn"))
    return unasked.unionByName(no_issuer).select("discount_id")


def q4_issuers_merchants(spark, sf):
    query = search.Query(
        merchant="furn|mach", issuers=["Banco BBVA", "Naranja X"], merchants=["Machinery"]
    )
    return search.refined(_published(spark, sf), query).select("discount_id")


def q5_days(spark, sf):
    return _flat(search.refined(_published(spark, sf), NARROW)).select("discount_id", "days")


def q6_formato(spark, sf):
    query = search.Query(**{**vars(NARROW), "formato": display.VALID_BOTH})
    shown = display.validity("discount_valid_online", "discount_valid_instore")
    return search.refined(_published(spark, sf), query).select("discount_id", shown.alias("formato"))


def q7_payment_types(spark, sf):
    query = search.Query(**{**vars(FOUND), "payment_types": ["Tarjeta de débito"]})
    types = F.array_join(
        F.array_sort(display.payment_types("discount_payment_methods_list")), ","
    )
    return search.refined(_published(spark, sf), query).select("discount_id", types.alias("types"))


def q8_active(spark, sf):
    return search.search(_published(spark, sf), FOUND, limit=None).select("discount_id")


def q9_facets(spark, sf):
    lists = search.facets(_published(spark, sf), NARROW)
    named = [df.select(F.lit(facet).alias("facet"), "value") for facet, df in lists.items()]
    result = named[0]
    for df in named[1:]:
        result = result.unionByName(df)
    return result


def q9_facets_one_pass(spark, sf):
    return search.facet_values(_published(spark, sf), NARROW)


def q9_facets_one_scan(spark, sf):
    return search.all_facets(_published(spark, sf), NARROW)


def q10_found_count(spark, sf):
    offers = _published(spark, sf)
    everything = search.Query(**{**vars(FOUND), "include_inactive": True})
    active = search.found_count(offers, FOUND).select(F.lit("active").alias("counted"), "discounts")
    total = search.found_count(offers, everything).select(F.lit("all").alias("counted"), "discounts")
    return active.unionByName(total)


# --- labels ----------------------------------------------------------------


def d1_days(spark, sf):
    first = F.substring("o_orderpriority", 1, 1).cast("bigint")
    week = F.sequence(F.lit(0).cast("bigint"), F.lit(6).cast("bigint"))
    days = (
        F.when(first == 1, week)
        .when(first == 2, F.array(F.lit(9).cast("bigint")))
        .otherwise(F.array(first, F.col("o_orderkey") % 7))
    )
    return table(spark, sf, "orders").select("o_orderkey", days.alias("days")).select(
        "o_orderkey",
        display.valid_days_text("days").alias("text"),
        F.array_join(display.day_names("days"), ",").alias("names"),
    )


def d2_percent(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        display.percent_text(F.col("l_discount") / 2).alias("text"),
    )


def d3_amounts(spark, sf):
    amount = F.when(F.col("o_orderstatus") == "F", 0.0).when(
        F.col("o_orderstatus") == "O", F.col("o_totalprice")
    )
    return table(spark, sf, "orders").select(
        "o_orderkey",
        display.installments_text(F.col("o_orderkey") % 5).alias("installments"),
        display.minimum_text(amount).alias("minimum"),
        display.cap_text(amount).alias("cap"),
    )


def d4_payment_text(spark, sf):
    text = display.payment_text("discount_payment_methods_list")
    return _normalised(spark, sf).select("discount_id", text.alias("text"))


def d5_payment_groups(spark, sf):
    text = display.payment_groups_text("discount_payment_methods_list")
    return _normalised(spark, sf).select("discount_id", text.alias("text"))


def d6_truncate(spark, sf):
    return table(spark, sf, "documents").select("doc_id", display.truncate_text("text").alias("text"))


def d7_day_text(spark, sf):
    known = F.when(F.col("o_orderstatus") != "P", F.to_date("o_orderdate"))
    return table(spark, sf, "orders").select("o_orderkey", display.day_text(known).alias("text"))


def d8_plain_key(spark, sf):
    """Also with characters that give several letters or lie beyond the basic plane."""
    odd = F.array(*[F.lit(text) for text in ODD_NAMES])
    docs = table(spark, sf, "documents")
    name = F.concat(F.element_at(odd, (F.col("doc_id") % len(ODD_NAMES) + 1).cast("int")), F.col("text"))
    return docs.select("doc_id", issuers.plain_key(name).alias("key"))


def d9_issuer_status(spark, sf):
    """The icon of the highest position wins, also from a seed of several shuffled files."""
    path = fresh_folder(spark, "icons")
    icons = [("Click", "viejo.png", 1), (" CLÍCK! ", "nuevo.png", 2), ("view", "view.png", 3), ("", "x.png", 4)]
    kinds = "issuer_name string, icon_file string, position int"
    for rows in (icons[1:], icons[:1]):
        spark.createDataFrame(rows, kinds).write.mode("append").parquet(path)
    return issuers.issuer_status(a1_issuer_summary(spark, sf), spark.read.schema(kinds).parquet(path))


def d_initcap(spark, sf):
    return table(spark, sf, "documents").select("doc_id", scalars.initcap_words("text").alias("title"))


def d_display_columns(spark, sf):
    shown = display.with_display_columns(_published(spark, sf))
    return shown.select(
        "discount_id",
        F.array_join("valid_days_names", ",").alias("names"),
        "valid_days_text",
        "formato",
        "rate_text",
        display.with_suffix("installments_text", " cuotas").alias("installments_text"),
        "minimum_text",
        "cap_text",
        F.array_join(F.array_sort("payment_method_types"), ",").alias("types"),
        "start_text",
        "end_text",
    )


# --- run metrics and streams -----------------------------------------------


def _log_lines(spark, sf) -> DataFrame:
    even = F.col("event_id") % 2 == 0
    blocked = F.when(F.col("event_type") == "error", F.col("event_id") % 10)
    stats = F.struct(
        F.col("user_id").alias("item_scraped_count"),
        F.col("value").alias("elapsed_time_seconds"),
        F.when(even, F.col("value") * 2).alias("responses_per_minute"),
        F.col("event_id").alias("items_per_minute"),
        blocked.alias("response_status_count/403"),
        F.col("event_type").alias("spider"),
        F.lit("finished").alias("finish_reason"),
    )
    text = F.to_json(stats, {"ignoreNullFields": "false"})
    line = F.concat(F.lit("2024-01-01 [run] INFO: WORKFLOW_STATS "), text)
    noise = F.lit("2024-01-01 [run] INFO: Spider opened")
    return table(spark, sf, "events").select("event_id", F.explode(F.array(line, noise)).alias("value"))


def r1_run_stats(spark, sf):
    return metrics.run_stats(_log_lines(spark, sf))


def r2_histogram(spark, sf):
    events = table(spark, sf, "events").select(F.col("event_type").alias("spider"), "value")
    return metrics.histogram(events, ["spider"])


def r2_run_histogram(spark, sf):
    values = metrics.long_metrics(metrics.run_stats(_log_lines(spark, sf)))
    return metrics.histogram(values, ["spider", "metric"])


def r2_histogram_stream(spark, sf):
    """The histogram merged from a stream's windows, in batches of files."""
    events = table(spark, sf, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("spider"), "value"
    )
    folder = fresh_folder(spark, "distribution")
    events.repartition(4).write.parquet(f"{folder}/values")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/values")

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/counts/batch={number}")

    counted = distributions.streaming_histogram(stream, ["spider"], lateness="3650 days", window="1 day")
    query = counted.writeStream.outputMode("update").foreachBatch(keep).trigger(availableNow=True)
    query.option("checkpointLocation", f"{folder}/checkpoint").start().awaitTermination()
    updates = spark.read.parquet(f"{folder}/counts")
    final = dedup.latest_by(updates, ["window_start", "spider", "bucket"], [F.desc("batch")])
    return distributions.merged_histogram(final, ["spider"])


def _runs(events: DataFrame) -> DataFrame:
    failed = F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCEEDED")
    return events.select(
        "ts", F.col("user_id").cast("string").alias("workflow_id"), failed.alias("status")
    )


def r3_failure_alerts(spark, sf):
    return metrics.failure_alerts(_runs(table(spark, sf, "events")))


def r3_failure_alerts_stream(spark, sf):
    """The same alerts from a stream over the table, kept in update mode."""
    # Watermarks need an instant, so the table's local times are read as such.
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    folder = fresh_folder(spark, "alerts")
    source = f"{folder}/runs"
    _runs(events).write.parquet(source)
    stream = spark.readStream.schema(_runs(events).schema).parquet(source)

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(
            f"{folder}/alerts/batch={number}"
        )

    query = (
        alerts.streaming_failure_alerts(stream, lateness="60 days")
        .writeStream.outputMode("update")
        .foreachBatch(keep)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    updates = spark.read.parquet(f"{folder}/alerts")
    final = dedup.latest_by(updates, ["window_start", "workflow_id"], [F.desc("batch")])
    return final.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "workflow_id",
        "failures",
    )


def r4_run_summary(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("event_type", "spider")
    executions = events.groupBy("spider").agg(F.max("event_id").cast("string").alias("execution"))
    arrived = events.filter("value >= 100").groupBy("spider").agg(F.count(F.lit(1)).alias("new_files"))
    path = fresh_folder(spark, "summary")
    metrics.append_run_summary(metrics.run_summary(executions, arrived, "build-1"), path)
    return spark.read.schema(
        "build_id string, spider string, execution string, new_files bigint"
    ).json(path)


def r5_landing_stream(spark, sf):
    path, folder = _landed(spark, sf), fresh_folder(spark, "stream")
    stream = landing_stream.read_landing_stream(spark, path, files_per_batch=200)
    landing_stream.start_landing_stream(
        stream, f"{folder}/newest", f"{folder}/checkpoint", TIE
    ).awaitTermination()
    newest = landing_stream.read_newest(spark, f"{folder}/newest")
    return _flat(newest).select(
        "source_id", "issuer_name", "last_updated_at_date", "seq", "discount_rate", "days", "methods"
    )


def r5_stream_fact(spark, sf):
    """From the stream to the fact table; the same rows as the batch load gives."""
    path, folder = _landed(spark, sf), fresh_folder(spark, "stream")
    stream = landing_stream.read_landing_stream(spark, path, files_per_batch=100)
    landing_stream.start_landing_stream(stream, f"{folder}/newest", f"{folder}/checkpoint", TIE).awaitTermination()
    landing_stream.stream_fact(spark, f"{folder}/newest", f"{folder}/fact", *_category_seeds(spark))
    return _flat(tables.read_version(spark, f"{folder}/fact"))


def r5_fact_upserts(spark, sf):
    """The fact that the stream upserts batch by batch from keyed state."""
    path, folder = _landed(spark, sf), fresh_folder(spark, "stream")
    stream = landing_stream.read_landing_stream(spark, path, files_per_batch=200)
    fact_stream.start_fact_stream(
        stream, f"{folder}/tables", f"{folder}/checkpoint", TIE, *_category_seeds(spark), buckets=16
    ).awaitTermination()
    return _flat(fact_stream.read_fact(spark, f"{folder}/tables"))


def _build_seeds(spark) -> dict[str, DataFrame]:
    overrides, categories = _category_seeds(spark)
    return {"merchant_overrides": overrides, "merchant_categories": categories}


def b_build_fact(spark, sf):
    """The build from raw records to published tables, its checks not enforced."""
    path = fresh_folder(spark, "build")
    plan.build(
        spark, _raw(spark, sf), path, as_of=AS_OF, tie_path=TIE, enforce=False, seeds=_build_seeds(spark)
    )
    return _flat(tables.read_version(spark, f"{path}/fact"))


def b_incremental_build(spark, sf):
    """A load up to a cutoff, then a run that reads the later partitions only."""
    path, raw = fresh_folder(spark, "build"), _raw(spark, sf)
    for cutoff in (CUTOFF, None):
        plan.build(
            spark, raw, path, as_of=AS_OF, cutoff=cutoff, tie_path=TIE, enforce=False, seeds=_build_seeds(spark)
        )
    return _flat(tables.read_version(spark, f"{path}/fact"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = {
        name: function
        for name, function in globals().items()
        if callable(function)
        and getattr(function, "__module__", "") == __name__
        and name != "queries"
        and not name.startswith("_")
    }
    return dict(sorted(named.items()))
