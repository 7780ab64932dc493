"""The published category of a merchant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import initcap_words

# Fixed value: the category of offers no rule knows.
UNCATEGORISED = "Sin categorizar"


def lookup_chain(
    df: DataFrame,
    target: str,
    steps: list[tuple[DataFrame, list[tuple[str, str]], str]],
    default: str,
) -> DataFrame:
    """The first value found by case-blind lookups in the given order.

    A step is (dimension, [(column of df, column of dimension)...], value). No
    join is forced: Spark broadcasts a dimension it measures as small, and
    splits skewed keys of a sort-merge join otherwise.
    """
    found: list[Column] = []
    for i, (dim, pairs, value) in enumerate(steps):
        side = dim.select(
            *[F.lower(right).alias(f"_k{i}_{j}") for j, (_, right) in enumerate(pairs)],
            F.col(value).alias(f"_v{i}"),
        )
        on = [F.lower(df[left]) == side[f"_k{i}_{j}"] for j, (left, _) in enumerate(pairs)]
        df = df.join(side, on, "left").drop(*[f"_k{i}_{j}" for j in range(len(pairs))])
        found.append(F.col(f"_v{i}"))
    return df.withColumn(target, F.coalesce(*found, F.lit(default))).drop(
        *[f"_v{i}" for i in range(len(steps))]
    )


def resolve_category(df: DataFrame, overrides: DataFrame, categories: DataFrame) -> DataFrame:
    """Merchant override, else the issuer's mapping, else uncategorised."""
    resolved = lookup_chain(
        df,
        "merchant_category_clean",
        [
            (overrides, [("merchant_name", "merchant_name")], "normalized_category"),
            (
                categories,
                [("issuer_name", "issuer"), ("merchant_category_name", "raw_merchant_category_name")],
                "parsed_merchant_category_name",
            ),
        ],
        UNCATEGORISED,
    )
    return resolved.drop("merchant_category_name").withColumn(
        "merchant_name", initcap_words("merchant_name")
    )
