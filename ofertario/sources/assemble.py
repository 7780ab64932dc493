"""Raw items from captured catalogue and detail responses.

Inputs are frames of captured responses, one row per response, with the body
as VARIANT. Catalogue pages are opened into entries, entries joined with the
details of their id, and the keys of both put together: where both have a key
the detail wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import jsonx
from ..functions.scalars import extract

FIELDS = "map<string, variant>"


def _named(fields: dict[str, Column]) -> Column:
    """Named values as a map of VARIANTs; a missing value is a JSON null."""
    pairs = []
    for name, value in fields.items():
        pairs += [F.lit(name), F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))]
    return F.create_map(*pairs)


def merged(base: Column, detail: Column) -> Column:
    """One object with the keys of both; the detail's value wins."""
    extra = F.map_filter(base, lambda k, v: ~F.map_contains_key(detail, k))
    return F.to_variant_object(F.map_concat(extra, detail))


def _entries(pages: DataFrame, path: str, *keep: str) -> DataFrame:
    return pages.select(*keep, F.explode(jsonx.json_array("body", path)).alias("entry"))


def page_count_in(message: Column) -> Column:
    """The page count a catalogue message tells."""
    return extract(message, r"paginas:\s*(\d+)").try_cast("bigint")


def page_count_of(total: Column, per_page: Column) -> Column:
    return F.ceil(F.try_divide(total, per_page)).cast("bigint")


def _identified(key: Column) -> Column:
    """An id that counts as given: not missing, null, '', 0 or false."""
    text = jsonx.json_value(key)
    return text.isNotNull() & ~text.isin("", "0", "false")


def _landed(items: DataFrame, spider: str) -> DataFrame:
    return items.select("raw_payload", F.lit(spider).alias("spider"), "scraped_at_dt")


def assemble_bbva(catalogue: DataFrame, details: DataFrame) -> DataFrame:
    """catalogue(category_name, scraped_at_dt, body), details(id, scraped_at_dt, body)."""
    entries = _entries(catalogue, "$.data", "category_name", "scraped_at_dt")
    entries = entries.withColumn("_id", jsonx.json_query("entry", "$.id"))
    keyed = entries.filter(_identified(F.col("_id"))).select(
        jsonx.json_value("_id").alias("id"),
        "scraped_at_dt",
        _named(
            {
                "source_id": F.col("_id"),
                "discount_start_date": jsonx.json_query("entry", "$.fechaDesde"),
                "discount_end_date": jsonx.json_query("entry", "$.fechaHasta"),
                "subcabecera": jsonx.json_query("entry", "$.subcabecera"),
                "category_name": F.col("category_name"),
            }
        ).alias("base"),
    )
    found = details.select(
        "id", "scraped_at_dt", F.try_variant_get("body", "$.data", FIELDS).alias("detail")
    )
    items = keyed.join(found, ["id", "scraped_at_dt"]).withColumn(
        "raw_payload", merged(F.col("base"), F.col("detail"))
    )
    return _landed(items, "bbva")


def assemble_galicia(catalogue: DataFrame, details: DataFrame) -> DataFrame:
    """catalogue(scraped_at_dt, body), details(id, scraped_at_dt, body)."""
    entries = _entries(catalogue, "$.data.list", "scraped_at_dt").withColumn(
        "_id", jsonx.json_query("entry", "$.id")
    )
    keyed = entries.filter(_identified(F.col("_id"))).select(
        jsonx.json_value("_id").alias("id"),
        "scraped_at_dt",
        _named({"source_id": F.col("_id")}).alias("base"),
    )
    found = details.select(
        "id", "scraped_at_dt", F.try_variant_get("body", "$.data", FIELDS).alias("detail")
    )
    items = keyed.join(found, ["id", "scraped_at_dt"]).withColumn(
        "raw_payload", merged(F.col("base"), F.col("detail"))
    )
    return _landed(items, "galicia")


def naranjax_plans(catalogue: DataFrame, commerces: DataFrame) -> DataFrame:
    """The (commerce, plan, discount_url) of every detail worth asking for.

    catalogue(scraped_at_dt, body), commerces(commerce, scraped_at_dt, status, body).
    An entry with a detail address is one plan; any other has the plans its
    commerce response lists.
    """
    entries = _entries(catalogue, "$.data", "scraped_at_dt").select(
        "scraped_at_dt",
        jsonx.json_value("entry", "$.url").alias("commerce"),
        jsonx.json_value("entry", "$.urlDetail").alias("plan"),
        jsonx.json_value("entry", "$.fullUrl").alias("discount_url"),
    )
    has_plan = F.coalesce(F.col("plan") != "", F.lit(False))
    single = entries.filter(has_plan)
    listed = commerces.filter(F.col("status") == 200).select(
        "commerce",
        "scraped_at_dt",
        F.explode(jsonx.json_array("body", "$.nearCurrent")).alias("near"),
    )
    several = (
        entries.filter(~has_plan)
        .drop("plan")
        .join(listed, ["commerce", "scraped_at_dt"])
        .withColumn("plan", jsonx.json_value("near", "$.url"))
        .withColumn("discount_url", F.concat_ws("/", "discount_url", "plan"))
        .drop("near")
    )
    return single.unionByName(several)


def assemble_naranjax(catalogue: DataFrame, commerces: DataFrame, details: DataFrame) -> DataFrame:
    """details(commerce, plan, scraped_at_dt, status, body); failed ones are dropped."""
    plans = naranjax_plans(catalogue, commerces)
    found = details.filter(F.col("status") == 200).select(
        "commerce",
        "plan",
        "scraped_at_dt",
        F.try_variant_get("body", "$", FIELDS).alias("detail"),
    )
    base = _named(
        {
            "id": F.concat_ws("_", "commerce", "plan"),
            "discount_url": F.col("discount_url"),
        }
    )
    items = plans.join(found, ["commerce", "plan", "scraped_at_dt"]).withColumn(
        "raw_payload", merged(base, F.col("detail"))
    )
    return _landed(items, "naranjax")
