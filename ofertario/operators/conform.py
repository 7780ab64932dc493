"""The uniform staging schema, the union of the sources, the business filter."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

STAGING_TYPES = {
    "source_id": "string",
    "issuer_name": "string",
    "merchant_name": "string",
    "merchant_category_name": "string",
    "discount_start_date": "date",
    "discount_end_date": "date",
    "discount_rate": "double",
    "discount_name": "string",
    "discount_description": "string",
    "discount_terms_and_conditions": "string",
    "discount_url": "string",
    "discount_max_discount_amount": "double",
    "discount_min_purchase_amount": "double",
    "discount_no_interest_installment_qty": "bigint",
    "discount_valid_days_list": "array<bigint>",
    "discount_valid_online": "boolean",
    "discount_valid_instore": "boolean",
    "discount_payment_methods_list": (
        "array<struct<type: string, card_network: string, card_tier: string>>"
    ),
    "discount_metadata": "variant",
    "scraped_at_dt": "date",
}


def conform(df: DataFrame, source: str) -> DataFrame:
    """The staging columns, in order and type; others are dropped.

    The records are counted as they pass, as the metric ``records_<source>_…``.
    The count also keeps Catalyst from moving later predicates below the rules:
    each rule would be copied into them wherever it is used, and parsing a
    payload dozens of times costs far more than filtering after it. Partition
    filters therefore belong on the raw frame.
    """
    uniform = df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in STAGING_TYPES.items()])
    return uniform.observe(
        f"records_{source}_{uuid.uuid4().hex}", F.count(F.lit(1)).alias("records")
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources by column name, the scrape date under its later name."""
    united = reduce(lambda a, b: a.unionByName(b), frames)
    return united.withColumnRenamed("scraped_at_dt", "last_updated_at_date")


def worth_showing(
    rate: str = "discount_rate",
    installments: str = "discount_no_interest_installment_qty",
    instore: str = "discount_valid_instore",
    online: str = "discount_valid_online",
):
    """Gives something and can be used somewhere; unknown is not enough."""
    gives = (F.col(rate) != 0) | (F.col(installments) != 0)
    usable = F.col(instore) | F.col(online)
    return gives & usable


def keep_worth_showing(df: DataFrame) -> DataFrame:
    return df.filter(worth_showing())
