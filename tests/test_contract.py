from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF
from contract import oracles
from contract import queries as registered

CHEAP = "djklmtu"
DEEP = ["b_build_fact", "n1_resolve_category", "p6_serving_table", "q9_facets", "r5_landing_stream"]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def result_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_its_twin():
    ours = set(registered.queries())
    assert ours == set(oracles.oracle_sql())
    assert ours <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == ["issuer_name", "last_scraped_at", "discount_count"]


@pytest.mark.parametrize(
    "name", sorted({n for n in registered.queries() if n[0] in CHEAP and n[1].isdigit()} | set(DEEP))
)
def test_query_equals_its_twin(spark, db, name):
    df = contract.queries()[name](spark, SF)
    twin = db.sql(contract.oracle_sql()[name])
    assert result_rows(df.columns, df.collect()) == result_rows(twin.columns, twin.fetchall())
