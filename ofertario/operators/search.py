"""Faceted search over the serving table.

Every condition is a column predicate, so the scan reads the needed columns
only and what parquet can test is tested there. Results leave through a top-k
sort; facet lists are distinct values, reduced before they are shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import display

# Sort choices and their columns.
ORDER_COLUMNS = {
    "rate": "discount_rate",
    "installments": "discount_no_interest_installment_qty",
}
PAGE_SIZE = 20


@dataclass(frozen=True)
class Query:
    merchant: str | None = None
    category: str | None = None
    issuers: list[str] = field(default_factory=list)
    days: list[int] = field(default_factory=list)
    merchants: list[str] = field(default_factory=list)
    formato: str | None = None
    payment_types: list[str] = field(default_factory=list)
    order_by: str = "rate"
    include_inactive: bool = False
    literal: bool = False

    @property
    def text(self) -> str:
        return (self.merchant or "").strip()


def text_matches(column: str, text: str, literal: bool = False) -> Column:
    """Case-blind regular expression (or literal text) anywhere; NULL is no."""
    if literal:
        text = r"\Q" + text.replace(r"\E", r"\E\\E\Q") + r"\E"
    pattern = f"(?iu){text}"
    return F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def prefiltered(df: DataFrame, query: Query) -> DataFrame:
    """By merchant text and category; nothing when neither is given."""
    if not query.text and not query.category:
        return df.filter(F.lit(False))
    if query.text:
        df = df.filter(text_matches("merchant_name", query.text, query.literal))
    if query.category:
        df = df.filter(F.col("merchant_category_name") == query.category)
    return df


def by_issuer_and_day(df: DataFrame, query: Query) -> DataFrame:
    """Of the chosen issuers and valid on a chosen day (0 is Monday)."""
    if not query.issuers:
        return df.filter(F.lit(False))
    df = df.filter(F.col("issuer_name").isin(*query.issuers))
    if query.days:
        chosen = F.array(*[F.lit(d).cast("bigint") for d in query.days])
        overlap = F.arrays_overlap("discount_valid_days_list", chosen)
        df = df.filter(F.coalesce(overlap, F.lit(False)))
    return df


def refined(df: DataFrame, query: Query) -> DataFrame:
    """All conditions but the active flag."""
    df = by_issuer_and_day(prefiltered(df, query), query)
    if query.merchants:
        df = df.filter(F.col("merchant_name").isin(*query.merchants))
    if query.formato:
        shown = display.validity("discount_valid_online", "discount_valid_instore")
        df = df.filter(shown == query.formato)
    if query.payment_types:
        chosen = F.array(*[F.lit(t) for t in query.payment_types])
        types = display.payment_types("discount_payment_methods_list")
        df = df.filter(F.arrays_overlap(types, chosen))
    return df


def ordered(df: DataFrame, query: Query) -> DataFrame:
    """Best offer first, unknown last; ids settle ties."""
    return df.orderBy(
        F.desc_nulls_last(ORDER_COLUMNS[query.order_by]),
        F.asc_nulls_last("merchant_name"),
        F.asc("discount_id"),
    )


def search(df: DataFrame, query: Query, limit: int | None = PAGE_SIZE, offset: int = 0) -> DataFrame:
    """One page of results; ``limit=None`` gives all of them."""
    found = refined(df, query)
    if not query.include_inactive:
        found = found.filter("discount_is_active")
    found = ordered(found, query)
    if offset:
        found = found.offset(offset)
    return found if limit is None else found.limit(limit)


def result_total(df: DataFrame, query: Query) -> DataFrame:
    """How many rows ``search`` gives over all its pages."""
    found = refined(df, query)
    counted = F.count(F.lit(1)) if query.include_inactive else F.count_if("discount_is_active")
    return found.agg(counted.alias("discounts"))


def _behind(df_column: str, value, descending: bool) -> tuple[Column, Column]:
    """(comes later, is equal) in an order with unknown values last."""
    column = F.col(df_column)
    if value is None:
        return F.lit(False), column.isNull()
    later = column < F.lit(value) if descending else column > F.lit(value)
    return F.coalesce(later, F.lit(True)), column.eqNullSafe(F.lit(value))


def search_after(df: DataFrame, query: Query, last: tuple | None, limit: int = PAGE_SIZE) -> DataFrame:
    """The page behind the row ``last`` (sort value, merchant_name, discount_id); None
    starts. Unlike an offset it sorts no row of the pages before."""
    if last is None:
        return search(df, query, limit)
    later, equal = F.lit(False), F.lit(True)
    columns = [(ORDER_COLUMNS[query.order_by], True), ("merchant_name", False), ("discount_id", False)]
    for (column, descending), value in zip(columns, last, strict=True):
        behind, same = _behind(column, value, descending)
        later, equal = later | (equal & behind), equal & same
    return search(df.filter(later), query, limit)


def last_of(page: list, query: Query) -> tuple | None:
    """Where the next page starts; None after an empty page."""
    return tuple(page[-1][c] for c in (ORDER_COLUMNS[query.order_by], "merchant_name", "discount_id")) if page else None


def found_count(df: DataFrame, query: Query) -> DataFrame:
    """Rows the text and category find, active ones only unless asked."""
    counted = F.count(F.lit(1)) if query.include_inactive else F.count_if("discount_is_active")
    return prefiltered(df, query).agg(counted.alias("discounts"))


def distinct_values(df: DataFrame, column: str, name: str = "value") -> DataFrame:
    """The facet list of a column: distinct, sorted, without NULL."""
    values = df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull())
    return values.distinct().orderBy(name)


def distinct_elements(df: DataFrame, elements: Column, name: str = "value") -> DataFrame:
    return df.select(F.explode(elements).alias(name)).distinct().orderBy(name)


def facets(df: DataFrame, query: Query) -> dict[str, DataFrame]:
    """Each facet's choices at the step of the search where it is offered."""
    found = prefiltered(df, query)
    narrowed = by_issuer_and_day(found, query)
    shown = display.validity("discount_valid_online", "discount_valid_instore")
    return {
        "category": distinct_values(df, "merchant_category_name"),
        "issuer": distinct_values(found, "issuer_name"),
        "merchant": distinct_values(narrowed, "merchant_name"),
        "formato": distinct_values(narrowed.withColumn("formato", shown), "formato"),
        "payment_type": distinct_elements(
            narrowed, display.payment_types("discount_payment_methods_list")
        ),
    }


def facet_values(df: DataFrame, query: Query) -> DataFrame:
    """The three result facets (facet, value) in a single pass."""
    shown = display.validity("discount_valid_online", "discount_valid_instore")

    def entry(facet: str, value) -> Column:
        return F.struct(F.lit(facet).alias("facet"), value.alias("value"))

    types = F.transform(
        display.payment_types("discount_payment_methods_list"),
        lambda t: F.struct(F.lit("payment_type").alias("facet"), t.alias("value")),
    )
    entries = F.concat(
        F.array(entry("merchant", F.col("merchant_name")), entry("formato", shown)), types
    )
    return (
        by_issuer_and_day(prefiltered(df, query), query)
        .select(F.inline(entries))
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("facet", "value")
    )


def _found(query: Query) -> Column:
    """``prefiltered`` as a condition."""
    if not query.text and not query.category:
        return F.lit(False)
    found = F.lit(True)
    if query.text:
        found = found & text_matches("merchant_name", query.text, query.literal)
    if query.category:
        found = found & F.coalesce(F.col("merchant_category_name") == query.category, F.lit(False))
    return found


def _narrowed(query: Query) -> Column:
    """``by_issuer_and_day`` as a condition."""
    if not query.issuers:
        return F.lit(False)
    narrowed = F.coalesce(F.col("issuer_name").isin(*query.issuers), F.lit(False))
    if query.days:
        chosen = F.array(*[F.lit(d).cast("bigint") for d in query.days])
        narrowed = narrowed & F.coalesce(F.arrays_overlap("discount_valid_days_list", chosen), F.lit(False))
    return narrowed


def all_facets(df: DataFrame, query: Query) -> DataFrame:
    """(facet, value) of all five facets in one scan, each under its own condition."""
    shown = display.validity("discount_valid_online", "discount_valid_instore")
    found, both = F.col("_found"), F.col("_found") & F.col("_narrowed")

    def entry(facet: str, value: Column, condition: Column | None = None) -> Column:
        pair = F.struct(F.lit(facet).alias("facet"), value.alias("value"))
        return pair if condition is None else F.when(condition, pair)

    types = F.transform(
        display.payment_types("discount_payment_methods_list"),
        lambda t: F.struct(F.lit("payment_type").alias("facet"), t.alias("value")),
    )
    single = F.array(
        entry("category", F.col("merchant_category_name")),
        entry("issuer", F.col("issuer_name"), found),
        entry("merchant", F.col("merchant_name"), both),
        entry("formato", shown, both),
    )
    entries = F.concat(single, F.coalesce(F.when(both, types), F.array().cast("array<struct<facet:string,value:string>>")))
    flagged = df.withColumn("_found", _found(query)).withColumn("_narrowed", _narrowed(query))
    return flagged.select(F.inline(entries)).filter(F.col("value").isNotNull()).distinct().orderBy("facet", "value")
