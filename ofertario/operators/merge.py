"""The fact projection and its incremental upsert."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

# Fact column <- normalised column.
FACT_COLUMNS = {
    "id": "discount_id",
    "issuer_name": "issuer_name",
    "merchant_name": "merchant_name",
    "merchant_category_name": "merchant_category_clean",
    "start_date": "discount_start_date",
    "end_date": "discount_end_date",
    "rate": "discount_rate",
    "no_interest_installment_qty": "discount_no_interest_installment_qty",
    "name": "discount_name",
    "description": "discount_description",
    "url": "discount_url",
    "terms_and_conditions": "discount_terms_and_conditions",
    "max_discount_amount": "discount_max_discount_amount",
    "min_purchase_amount": "discount_min_purchase_amount",
    "valid_days_list": "discount_valid_days_list",
    "valid_online": "discount_valid_online",
    "valid_instore": "discount_valid_instore",
    "payment_methods_list": "discount_payment_methods_list",
    "last_updated_at_date": "last_updated_at_date",
}


def fact_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).alias(name) for name, c in FACT_COLUMNS.items()])


def newer_than(df: DataFrame, target: DataFrame, date: str = "last_updated_at_date") -> DataFrame:
    """Rows dated after everything in ``target``; none when it is empty."""
    newest = target.agg(F.max(date))
    return df.filter(F.col(date) > newest.scalar())


def up_to(df: DataFrame, cutoff: dt.date | None, date: str = "last_updated_at_date") -> DataFrame:
    return df if cutoff is None else df.filter(F.col(date) <= F.lit(cutoff))


def upsert(target: DataFrame, incoming: DataFrame, key: str = "id") -> DataFrame:
    """Incoming rows replace those of the same key; no other row is touched.

    Only the keys of the incoming side travel for the match. A batch that is
    small next to the target is broadcast by Spark once it measured its size.
    """
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming)
