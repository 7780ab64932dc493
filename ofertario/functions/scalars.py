"""Scalar rules the built-ins almost have, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_FLOAT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+\s*$"

# The characters besides whitespace that start a new word.
WORD_BREAKS = r"""\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-"""


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.regexp_replace(_col(c), r"(?U)^\s+|\s+\z", "")


def initcap_words(c) -> Column:
    """Capitalise each word, where punctuation parts words too."""
    tokens = F.regexp_extract_all(
        _col(c), F.lit(rf"[\s{WORD_BREAKS}]+|[^\s{WORD_BREAKS}]+"), F.lit(0)
    )
    return F.array_join(F.transform(tokens, F.initcap), "")


def extract(c, pattern: str, group: int = 1) -> Column:
    """The first match's group; NULL when nothing matches."""
    c = _col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def safe_double(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(_FLOAT), F.trim(c).try_cast("double"))


def safe_decimal(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(_FLOAT), F.trim(c).try_cast("decimal(38,9)"))


def safe_bigint(c) -> Column:
    c = _col(c)
    return F.when(c.rlike(_INTEGER), F.trim(c).try_cast("bigint"))


def safe_bool(c) -> Column:
    """Only ``true`` and ``false``, in any case, are booleans."""
    word = F.lower(_col(c))
    return F.when(word == "true", True).when(word == "false", False)


def greatest_or_null(c, floor) -> Column:
    """``greatest`` that stays NULL for a NULL input."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(floor)))


def parse_day(c, pattern: str, strict: bool = False) -> Column:
    """A date from text; a bad date is NULL, or an error when ``strict``."""
    c = _col(c)
    return F.to_date(c, pattern) if strict else F.try_to_date(c, pattern)


def typed_null(kind: str) -> Column:
    return F.lit(None).cast(kind)
