"""What readers of the published tables see."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_PREFIXED = [
    "start_date",
    "end_date",
    "is_active",
    "rate",
    "no_interest_installment_qty",
    "name",
    "description",
    "url",
    "terms_and_conditions",
    "max_discount_amount",
    "min_purchase_amount",
    "valid_days_list",
    "valid_online",
    "valid_instore",
    "payment_methods_list",
]


def is_active(start, end, as_of: dt.date | None = None) -> Column:
    """Started by ``as_of`` and ending after it; the last day no longer counts."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return (F.col(start) <= today) & (F.col(end) > today)


def serving_table(fact: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    flagged = fact.withColumn("is_active", is_active("start_date", "end_date", as_of))
    return flagged.select(
        F.col("id").alias("discount_id"),
        "issuer_name",
        "merchant_name",
        "merchant_category_name",
        *[F.col(c).alias(f"discount_{c}") for c in _PREFIXED],
        "last_updated_at_date",
    )


def issuer_summary(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("issuer_name").isNotNull())
        .groupBy("issuer_name")
        .agg(
            F.max("last_updated_at_date").alias("last_scraped_at"),
            F.count(F.lit(1)).alias("discount_count"),
        )
        .filter(F.col("discount_count") > 0)
        .orderBy("issuer_name")
    )


def summary_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("issuers"),
        F.coalesce(F.sum("discount_count"), F.lit(0)).alias("discounts"),
    )


def result_counts(found: DataFrame) -> DataFrame:
    return found.agg(
        F.count(F.lit(1)).alias("discounts"),
        F.count_if("discount_is_active").alias("active_discounts"),
    )


def load_discounts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_issuers(spark: SparkSession, path: str) -> DataFrame:
    columns = ["issuer_name", "last_scraped_at", "discount_count"]
    return spark.read.parquet(path).select(*columns).orderBy("issuer_name")


