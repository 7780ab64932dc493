"""Mapping raw values through a dimension, also inside arrays.

The result is the same for every size of the dimension: elements in array order,
and the entries of one key in the order of their values, NULL first. A dimension of
at most ``INLINE_ROWS`` rows becomes a literal map, one more expression of the
scan stage. A larger one is joined: the *distinct* arrays of raw keys are mapped
and joined back by the array, so rows need no id. Keys are compared and values
given as text. Rows with long texts are dealt to tasks by key, so that the files they
are written to hold a text once and not once a row.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

INLINE_ROWS = 256
#: Bytes of different texts for one task. Parquet holds up to 1 MB of a column's different
#: values once in each file; where there are more, it holds the value of every row. Less than
#: that, as tasks get uneven shares.
HELD_BYTES = 256 * 1024
MOST_TASKS = 10_000


def small_rows(dim: DataFrame, columns: list[str], limit: int = INLINE_ROWS) -> list[tuple] | None:
    """The rows of a dimension proven to have at most ``limit``, else None."""
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    rows = dim.select(*texts).limit(limit + 1).collect()
    return [tuple(r) for r in rows] if len(rows) <= limit else None


def _entry_type(names: list[str]) -> str:
    return f"struct<{', '.join(f'{n}: string' for n in names)}>"


def _key(parts: list[Column]) -> Column:
    return F.struct(*[part.cast("string").alias(f"k{i}") for i, part in enumerate(parts)])


def literal_map(rows: list[tuple], key_count: int, names: list[str]) -> Column:
    """Rows of (keys..., values...) as a literal map from key to value structs."""
    found: dict[tuple, list[dict]] = {}
    for row in rows:
        key = tuple(None if k is None else str(k) for k in row[:key_count])
        if None not in key:
            found.setdefault(key, []).append(dict(zip(names, row[key_count:])))
    def in_order(value: dict) -> list[tuple]:
        return [(v is not None, (v or "").encode()) for v in value.values()]

    entries = [
        {"key": {f"k{i}": part for i, part in enumerate(key)}, "value": sorted(values, key=in_order)}
        for key, values in found.items()
    ]
    key_type = _entry_type([f"k{i}" for i in range(key_count)])
    entry_type = f"struct<key: {key_type}, value: array<{_entry_type(names)}>>"
    literal = F.lit(json.dumps(entries, ensure_ascii=False))
    return F.map_from_entries(F.from_json(literal, f"array<{entry_type}>"))


def _keyed_entries(dim: DataFrame, keys: list[str], values: list[str], names: list[str]) -> DataFrame:
    """A large dimension as (_key0.., _entry)."""
    entry = F.struct(*[F.col(v).cast("string").alias(n) for v, n in zip(values, names)])
    keyed = [F.col(k).cast("string").alias(f"_key{i}") for i, k in enumerate(keys)]
    return dim.select(*keyed, entry.alias("_entry"))


def _as_rows(dim: DataFrame | list[tuple], columns: list[str]) -> list[tuple] | None:
    """The rows of a dimension that is small enough for a literal."""
    if isinstance(dim, list):
        return [tuple(None if v is None else str(v) for v in r) for r in dim] if len(dim) <= INLINE_ROWS else None
    return small_rows(dim, columns)


def _as_frame(dim: DataFrame | list[tuple], columns: list[str], df: DataFrame) -> DataFrame:
    if not isinstance(dim, list):
        return dim
    rows = [tuple(None if v is None else str(v) for v in r) for r in dim]
    return df.sparkSession.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def map_value(
    df: DataFrame,
    target: str,
    parts: list[Column],
    dim: DataFrame | list[tuple],
    keys: list[str],
    values: list[str],
    names: list[str],
    shown: Callable[[Column], Column] = lambda entries: entries,
) -> DataFrame:
    """``target``: all dimension entries of one key per row, ``[]`` for none.

    ``shown`` gives what a row gets of its entries, as their text; with a large dimension
    it is made once a key and not once a row.
    """
    rows = _as_rows(dim, keys + values)
    empty = F.array().cast(f"array<{_entry_type(names)}>")
    if rows is not None:
        found = F.try_element_at(literal_map(rows, len(keys), names), _key(parts))
        return df.withColumn(target, shown(F.coalesce(found, empty)))
    on = [f"_key{i}" for i in range(len(parts))]
    # Written, so that both sides of the join are plain and a hot key can be split.
    matches = written(
        _keyed_entries(_as_frame(dim, keys + values, df), keys, values, names)
        .dropna(subset=on)
        .groupBy(*on)
        .agg(F.array_sort(F.collect_list("_entry")).alias("_entries"))
        .select(*on, F.struct(shown(F.col("_entries")).alias("shown")).alias("_matches")),
        "matches",
    )
    keyed = df.withColumns({name: part.cast("string") for name, part in zip(on, parts)})
    joined = _joined(keyed, on, matches, "_matches")
    return joined.withColumn(target, _shown_or("_matches", shown(empty))).drop("_matches", *on)


def _joined(rows: DataFrame, on: list[str], found: DataFrame, column: str) -> DataFrame:
    """``rows``, each with what was found for its key in ``column``, NULL for nothing.

    Where the texts found have more than ``HELD_BYTES`` together, rows are counted by key in
    one more pass. Then each key goes to as many tasks as let every task have that many bytes
    of texts, and a key of more rows than a task's share, also NULL, to more of them.
    """
    if dict(found.dtypes)[column] != "struct<shown:string>":
        return rows.join(found, on, "left")
    size = F.coalesce(F.sum(F.octet_length(f"{column}.shown")), F.lit(0))
    if found.agg(size).first()[0] <= HELD_BYTES:
        return rows.join(found, on, "left")
    counted = written(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "rows-by-key")
    used = found.join(counted, on)
    held, total = used.agg(size).first()[0], counted.agg(F.sum("_rows")).first()[0]
    if held <= HELD_BYTES:
        return rows.join(found, on, "left")
    # Fewer than usual, Spark would shuffle anew for the join.
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, min(-(-held // HELD_BYTES), MOST_TASKS))
    usual = max(1, tasks * HELD_BYTES // held)
    share = -(-total // tasks)
    pieces = F.greatest(F.ceil(F.col("_rows") / share).cast("int"), F.lit(usual))
    # Fewer keys than tasks have more rows than a share.
    large = counted.filter(pieces > usual).select(*[F.col(k).alias(f"_large{k}") for k in on], pieces.alias("_pieces"))
    same = [F.col(k).eqNullSafe(F.col(f"_large{k}")) for k in on]
    hashed = [F.col(c) for c, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    piece = F.pmod(F.xxhash64(*hashed), F.coalesce("_pieces", F.lit(usual))).cast("int")
    dealt = rows.join(F.broadcast(large), same, "left").select(*rows.columns, piece.alias("_piece"))
    texts = used.withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1))).drop("_rows")
    by = [*on, "_piece"]
    texts = texts.repartition(tasks, *by).hint("shuffle_hash")
    return dealt.repartition(tasks, *by).join(texts, by, "left").drop("_piece")


def _shown_or(column: str, missing: Column) -> Column:
    """What is shown of the joined entries; ``missing`` where none were joined."""
    return F.when(F.col(column).isNull(), missing).otherwise(F.col(f"{column}.shown"))


def map_elements(
    df: DataFrame,
    target: str,
    elements: str,
    parts: Callable[[Column], list[Column]],
    dim: DataFrame | list[tuple],
    keys: list[str],
    values: list[str],
    names: list[str],
    shown: Callable[[Column], Column] = lambda entries: entries,
) -> DataFrame:
    """``target``: the entries of every array element, in element order.

    An element without a match gives one entry of NULLs; an empty or NULL
    array gives NULL. With a large dimension ``df`` is written first, so that
    what made it, as the parsing of payloads, is done once. ``shown`` gives what a row
    gets of its entries; with a large dimension it is made once a distinct array.
    """
    rows = _as_rows(dim, keys + values)
    nothing = F.array(F.struct(*[F.lit(None).cast("string").alias(n) for n in names]))
    if rows is not None:
        found = literal_map(rows, len(keys), names)
        mapped = F.flatten(
            F.transform(
                elements, lambda e: F.coalesce(F.try_element_at(found, _key(parts(e))), nothing)
            )
        )
        return df.withColumn(target, shown(F.when(F.size(mapped) > 0, mapped)))
    on = [f"_key{i}" for i in range(len(keys))]
    keyed = F.transform(elements, lambda e: _key(parts(e)))
    stable = written(df.withColumn("_keys", F.when(F.size(elements) > 0, keyed)), "keyed")
    arrays = stable.select("_keys").dropna().distinct()
    opened = arrays.select("_keys", F.posexplode("_keys").alias("_at", "_element"))
    opened = opened.withColumns({name: F.col(f"_element.k{i}") for i, name in enumerate(on)})
    entries = _keyed_entries(_as_frame(dim, keys + values, df), keys, values, names)
    none = F.struct(*[F.lit(None).cast("string").alias(n) for n in names])
    found = opened.join(entries, on, "left").select(
        "_keys", F.struct("_at", F.coalesce("_entry", none).alias("_entry")).alias("_found")
    )
    regrouped = written(
        found.groupBy("_keys")
        .agg(F.array_sort(F.collect_list("_found")).alias("_found"))
        .select("_keys", F.transform("_found", lambda f: f["_entry"]).alias("_entries"))
        .select("_keys", F.struct(shown(F.col("_entries")).alias("shown")).alias("_mapped")),
        "mapped-arrays",
    )
    nothing = F.lit(None).cast(f"array<{_entry_type(names)}>")
    joined = _joined(stable, ["_keys"], regrouped, "_mapped")
    joined = joined.withColumn(target, _shown_or("_mapped", shown(nothing)))
    return joined.drop("_keys", "_mapped")
