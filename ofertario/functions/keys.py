"""Surrogate keys and order-insensitive content hashes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .jsonx import struct_text

# Fixed value: what stands for NULL inside a key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# The fields that make two offers the same offer.
CONTENT_FIELDS = [
    "issuer_name",
    "merchant_name",
    "merchant_category_name",
    "discount_start_date",
    "discount_end_date",
    "discount_rate",
    "discount_max_discount_amount",
    "discount_min_purchase_amount",
    "discount_no_interest_installment_qty",
    "discount_valid_days_list",
    "discount_valid_online",
    "discount_valid_instore",
    "discount_payment_methods_list",
]


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*columns) -> Column:
    """MD5 of the columns as texts, NULL kept apart from every other value."""
    texts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *texts))


def number_list_text(numbers) -> Column:
    """The numbers in order; a NULL list is the empty text."""
    texts = F.transform(F.array_sort(_col(numbers)), lambda n: n.cast("string"))
    return F.coalesce(F.array_join(texts, ","), F.lit(""))


def struct_list_text(structs) -> Column:
    """The structs' texts in order; a NULL list is the empty text."""
    texts = F.array_sort(F.transform(_col(structs), struct_text))
    return F.coalesce(F.array_join(texts, ","), F.lit(""))


def content_hash(
    days: str = "discount_valid_days_list", methods: str = "discount_payment_methods_list"
) -> Column:
    """One hash for offers equal in every content field, whatever the list order."""
    canonical = {days: number_list_text(days), methods: struct_list_text(methods)}
    return surrogate_key(*[canonical.get(c, F.col(c)) for c in CONTENT_FIELDS])
