"""Access to semi-structured payloads held in VARIANT columns.

A path that is absent gives SQL NULL, a JSON null that is present gives a
VARIANT null: the two stay apart until a value is read as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_query(payload, path: str) -> Column:
    """The subtree at ``path`` as VARIANT."""
    return F.try_variant_get(_col(payload), path, "variant")


def _is_container(node: Column) -> Column:
    return F.schema_of_variant(node).rlike("^(ARRAY|OBJECT)")


def json_value(payload, path: str = "$") -> Column:
    """The scalar at ``path`` as text; NULL for objects, arrays and nulls.

    Containers are rendered as text that opens with a bracket, so only such
    text pays for the look at the node's type.
    """
    text = F.try_variant_get(_col(payload), path, "string")
    opens = F.substring(text, 1, 1).isin("{", "[")
    return F.when(opens & _is_container(json_query(payload, path)), F.lit(None)).otherwise(text)


def with_json_values(df: DataFrame, payload: str, paths: dict[str, str]) -> DataFrame:
    """``json_value`` of many paths, as columns, each path read once per row."""
    quoted = {name: path.replace("'", r"\'") for name, path in paths.items()}
    texts = [f"try_variant_get({payload}, '{p}', 'string') AS {n}" for n, p in quoted.items()]
    scalars = [
        f"""CASE WHEN substring({n}, 1, 1) IN ('{{', '[')
            AND schema_of_variant(try_variant_get({payload}, '{p}', 'variant'))
              RLIKE '^(ARRAY|OBJECT)'
            THEN NULL ELSE {n} END AS {n}"""
        for n, p in quoted.items()
    ]
    return df.selectExpr("*", *texts).selectExpr(*df.columns, *scalars)


def json_array(payload, path: str = "$") -> Column:
    """The elements at ``path``; NULL where there is no array."""
    return F.try_variant_get(_col(payload), path, "array<variant>")


def json_array_size(payload, path: str = "$") -> Column:
    return F.array_size(json_array(payload, path))


def json_value_array(payload, path: str = "$") -> Column:
    """The scalar elements at ``path`` as texts; NULL when one is a container."""
    nodes = json_array(payload, path)
    mixed = F.exists(nodes, lambda n: F.coalesce(_is_container(n), F.lit(False)))
    return F.when(~mixed, F.transform(nodes, lambda n: F.try_variant_get(n, "$", "string")))


def json_text(payload, path: str = "$") -> Column:
    """The subtree at ``path`` as JSON text."""
    return F.to_json(json_query(payload, path))


def has_content(payload) -> Column:
    """Neither missing nor a JSON null."""
    return _col(payload).isNotNull() & ~F.is_variant_null(_col(payload))


def has_key(payload, path: str) -> Column:
    """Whether the key exists, also when its value is a JSON null."""
    return json_query(payload, path).isNotNull()


def has_keys(payload, keys: list[str], joiner: str = "and") -> Column:
    """Whether all keys (``and``) or any key (``or``) exist; dots descend."""
    tests = [has_key(payload, f"$.{key}") for key in keys]
    if joiner == "and":
        return reduce(lambda a, b: a & b, tests)
    if joiner == "or":
        return reduce(lambda a, b: a | b, tests)
    raise ValueError("joiner is 'and' or 'or'")


def struct_text(value) -> Column:
    """A struct as JSON text that keeps null fields."""
    return F.to_json(_col(value), {"ignoreNullFields": "false"})
