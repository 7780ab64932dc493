"""A trigram index over distinct merchant names, for text search.

A text can match only names that hold all trigrams of one of its plain alternatives. The
index gives these names, the expression is then tried on them alone, and the offers are
read by name: where they are stored in the order of names, parquet skips the row groups
of others. Expressions with other syntax, and texts too short, are tried on all distinct
names. The result is always that of the expression itself.

Names and texts are folded alike before they are cut, so that whatever the expression
holds equal, apart from letter case, has the same trigrams.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .search import Query, text_matches

LONGEST_LIST = 256


def folded(text: Column) -> Column:
    """Letter case away, also of letters with several forms; no combining dot of an I.

    The dot goes in between, as Catalyst makes ``upper(lower(x))`` an ``upper(x)``.
    """
    return F.upper(F.replace(F.lower(text), F.lit("\u0307"), F.lit("")))


def trigrams(text: Column) -> Column:
    """The distinct trigrams of a folded text; none if it is shorter."""
    last = F.char_length(text) - 2
    cut = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, 3))
    return F.when(last >= 1, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def write_name_index(offers: DataFrame, path: str) -> None:
    """(trigram, name) in the order of trigrams, and the distinct names."""
    names = offers.select(F.col("merchant_name").alias("name")).filter("name IS NOT NULL").distinct()
    names.write.mode("overwrite").parquet(f"{path}/names")
    stored = offers.sparkSession.read.parquet(f"{path}/names")
    cut = stored.select(F.explode(trigrams(folded(F.col("name")))).alias("trigram"), "name")
    cut.repartitionByRange("trigram", "name").sortWithinPartitions("trigram", "name").write.mode("overwrite").parquet(
        f"{path}/trigrams"
    )


def alternatives(query: Query) -> list[str] | None:
    """The plain texts of which a match must hold one; None where that is not known."""
    if query.literal:
        return [query.text]
    found = query.text.split("|")
    return None if any(re.search(r"[^\w\s'&,;:@%=-]", part) for part in found) else found


def matching_names(spark: SparkSession, path: str, query: Query) -> DataFrame:
    """The distinct names that the text matches."""
    matches = text_matches("name", query.text, query.literal)
    plain = alternatives(query)
    if plain is not None:
        cut = spark.range(1).select(*[trigrams(folded(F.lit(p))).alias(str(i)) for i, p in enumerate(plain)]).first()
        if all(cut):
            index = spark.read.parquet(f"{path}/trigrams")
            wanted = index.filter(F.col("trigram").isin(sorted({t for own in cut for t in own})))
            counts = [F.count_if(F.col("trigram").isin(*own)) == len(own) for own in cut]
            holds = counts[0]
            for other in counts[1:]:
                holds = holds | other
            # The condition needs both, so the expression stays behind the counts.
            held = wanted.groupBy("name").agg(holds.alias("holds"))
            return held.filter(F.when(F.col("holds"), matches)).select("name")
    return spark.read.parquet(f"{path}/names").filter(matches)


def by_name(offers: DataFrame, path: str, query: Query) -> DataFrame:
    """``prefiltered`` of the search, through the index of the offers' names."""
    found = offers if query.text or query.category else offers.filter(F.lit(False))
    if query.category:
        found = found.filter(F.col("merchant_category_name") == query.category)
    if not query.text:
        return found
    names = matching_names(offers.sparkSession, path, query)
    few = [r["name"] for r in names.limit(LONGEST_LIST + 1).collect()]
    if len(few) <= LONGEST_LIST:
        return found.filter(F.col("merchant_name").isin(few))
    return found.join(names.withColumnRenamed("name", "merchant_name"), "merchant_name", "left_semi").select(*offers.columns)
