"""Mapping seeds: built-in values, or CSV files on shared storage."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import seed_values as values

_METHOD = ["parsed_type", "parsed_card_network", "parsed_card_tier"]

SEEDS = {
    "bbva_payment_methods": (["raw_grupo_tarjeta", *_METHOD], values.BBVA_PAYMENT_METHODS),
    "galicia_payment_methods": (
        ["raw_tarjeta", "raw_tipoTarjeta", *_METHOD],
        values.GALICIA_PAYMENT_METHODS,
    ),
    "naranja_payment_methods": (["raw_payment_method", *_METHOD], values.NARANJA_PAYMENT_METHODS),
    "merchant_categories": (
        ["issuer", "raw_merchant_category_name", "parsed_merchant_category_name"],
        values.MERCHANT_CATEGORIES,
    ),
    "merchant_overrides": (["merchant_name", "normalized_category"], values.MERCHANT_OVERRIDES),
    "issuer_icons": (
        ["issuer_name", "icon_file", "position"],
        [(*row, str(at)) for at, row in enumerate(values.ISSUER_ICONS)],
    ),
}


def values_frame(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A few literal string rows as a frame Catalyst knows to be tiny."""
    schema = ", ".join(f"`{c}`: string" for c in columns)
    literal = F.lit(json.dumps([dict(zip(columns, row)) for row in rows]))
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(literal, f"array<struct<{schema}>>")))


def read_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Seed ``name`` from the CSV at ``path``, else from the built-in values.

    Blank cells are NULL and a byte-order mark before the header is dropped.
    """
    columns, rows = SEEDS[name]
    if path is None:
        return values_frame(spark, columns, rows)
    schema = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.schema(schema).csv(
        path, header=True, nullValue="", emptyValue="", enforceSchema=True, escape='"'
    )
