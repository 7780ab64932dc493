from __future__ import annotations

import pyarrow as pa
import pytest

from ofertario.llm import mixing

BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unbound(spark):
    before = spark.conf.get(BYTES)
    spark.conf.unset(BYTES)
    yield spark
    spark.conf.set(BYTES, before)


def _measured(spark, monkeypatch) -> list[int]:
    """Bytes of the batches in which texts reach the mixer, by row."""

    def sizes(batches):
        for batch in batches:
            names = ["doc_id", "source", "row", "shuffle"]
            told = pa.array([batch.nbytes] * batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), told], [*names, "size"])

    monkeypatch.setattr(mixing, "_sizes", sizes)
    docs = spark.range(4000).repartition(1).selectExpr("id AS doc_id", "repeat('word ', 600) AS text", "'a' AS source")
    return [r["size"] for r in mixing.plan(docs, [3.0]).select("size").collect()]


def test_texts_reach_python_in_bounded_batches(unbound, monkeypatch):
    told = _measured(unbound, monkeypatch)
    assert len(told) == 4000 and max(told) < 3 << 20


@pytest.mark.parametrize("given", ["500000", "400k", "300000b"])
def test_a_smaller_bound_of_the_session_stays(unbound, monkeypatch, given):
    unbound.conf.set(BYTES, given)
    assert max(_measured(unbound, monkeypatch)) < 600_000
    assert int(unbound.conf.get(BYTES).rstrip("kb")) < 1 << 20
