from __future__ import annotations

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ofertario.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw(spark):
    """Raw records from Python payloads: raw(spider, payload, ..., day=...)."""

    def make(spider, *payloads, day="2025-06-01"):
        rows = [(json.dumps(p), spider, day) for p in payloads]
        df = spark.createDataFrame(rows, "body string, spider string, day string")
        return df.select(
            F.parse_json("body").alias("raw_payload"),
            "spider",
            F.to_date("day").alias("scraped_at_dt"),
        )

    return make


@pytest.fixture
def one(spark):
    """The value of one expression over one row of literals."""

    def value(column):
        return spark.range(1).select(column.alias("v")).first()["v"]

    return value
