"""Issuer status rows with their icons."""

from __future__ import annotations

import json
import re
import unicodedata

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.display import UNKNOWN
from ..functions.scalars import trim_ws
from .dedup import latest_by


def _plain_letters() -> tuple[dict[str, str], dict[str, str]]:
    """Characters that decompose to plain letters and digits: to one, and to several.

    Only small letters count, as names are lower-cased before they are decomposed.
    """
    one, several = {}, {}
    for char in map(chr, range(0x80, 0x110000)):
        parts = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode()
        plain = re.sub("[^a-z0-9]", "", parts)
        if plain:
            (one if len(plain) == 1 else several)[char] = plain
    return one, several


_PLAIN, _LONGER = _plain_letters()


def _ranges(chars) -> str:
    """Characters as the inside of a pattern's class, neighbours as one range."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and spans[-1][1] == code - 1:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in spans)


# Beyond ASCII first: the many ranges are then tried for few characters only.
_USELESS = rf"[\x{{80}}-\x{{10ffff}}&&[^{_ranges(_LONGER)}]]+"


def plain_key(name) -> Column:
    """Letters and digits only, lower case, without accents; '' for NULL.

    Everything that gives no letter leaves first. A text that still has characters beyond
    ASCII is cut into these and the runs between, so only they are looked up.
    """
    name = F.col(name) if isinstance(name, str) else name
    low = F.translate(F.lower(trim_ws(name)), "".join(_PLAIN), "".join(_PLAIN.values()))
    kept = F.regexp_replace(F.regexp_replace(low, r"[\x00-\x7f&&[^a-z0-9]]+", ""), _USELESS, "")
    longer = F.from_json(F.lit(json.dumps(_LONGER)), "map<string, string>")
    cut = F.regexp_extract_all(kept, F.lit(r"[\x00-\x7f]+|[^\x00-\x7f]"), F.lit(0))
    each = F.transform(cut, lambda c: F.when(c.rlike("^[a-z0-9]"), c).otherwise(F.try_element_at(longer, c)))
    letters = F.when(kept.rlike(r"[^\x00-\x7f]"), F.array_join(each, "")).otherwise(kept)
    return F.coalesce(letters, F.lit(""))


def icon_lookup(icons: DataFrame, position: str = "position") -> DataFrame:
    """One icon per key; of several the one with the highest ``position`` wins.

    The column must be there: rows of a table have no order of their own.
    """
    at = F.col(position)
    keyed = icons.select(plain_key("issuer_name").alias("issuer_key"), "icon_file", at.alias("_at"))
    known = keyed.filter((F.col("issuer_key") != "") & F.col("icon_file").isNotNull())
    return latest_by(known, ["issuer_key"], [F.desc("_at")]).drop("_at")


def issuer_status(summary: DataFrame, icons: DataFrame) -> DataFrame:
    """Issuers with count, last scrape and icon; unreadable values are blank."""
    return (
        summary.select(
            "issuer_name",
            F.col("last_scraped_at").try_cast("timestamp_ntz").alias("last_scraped_at"),
            F.coalesce(F.col("discount_count").try_cast("bigint"), F.lit(0)).alias("discount_count"),
            plain_key("issuer_name").alias("issuer_key"),
        )
        .withColumn(
            "last_scraped_label",
            F.coalesce(F.date_format("last_scraped_at", "dd/MM/yyyy HH:mm"), F.lit(UNKNOWN)),
        )
        .join(icon_lookup(icons), "issuer_key", "left")
    )
