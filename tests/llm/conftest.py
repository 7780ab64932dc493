from __future__ import annotations

import sys
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"

LONG = "Lorem +1 (555) 123-4567 ipsum apache license " * 4000
EDGES = [
    (9001, None, "en", "src1"),
    (9002, "", None, None),
    (9003, LONG, "en", None),
    (9004, "one two", "en", "src2"),
    (9005, "One  TWO", "en", "src2"),
    (9006, " \t\n", "en", "src3"),
    (9007, "123 456 ... 789", "en", "src3"),
    (9008, "repeated row here", "en", "src3"),
    (9008, "repeated row here", "en", "src3"),
    (9009, "repeated row here", "en", "src3"),
    (None, "no id at all", "en", "src3"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    """The small table with edge cases and columns that clash with inner names."""
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    both = table.unionByName(spark.createDataFrame(EDGES, SCHEMA))
    for name in ("row", "part", "size", "id", "gid", "kept", "copies", "digest", "stays", "ahead", "a.b"):
        both = both.withColumn(name, F.lit("own"))
    return both


@pytest.fixture(scope="session")
def rows(docs) -> pd.DataFrame:
    return docs.select("doc_id", "text", "lang", "source").toPandas().astype({"doc_id": "Int64"})


@pytest.fixture(scope="session")
def empty(docs):
    return docs.where("false")
