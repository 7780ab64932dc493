from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from ofertario.llm import language, mixing, queries
from pyspark.sql import functions as F

from llm_helpers import text_of
from test_dedup_and_join import brute_components

SF = "/root/testdata/sf0.001"

NAMES = ["language", "exact_dedup", "near_dedup", "mix", "pack"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage kept, by name; ``documents`` is the input."""
    out, folder = {"documents": spark.read.parquet(f"{SF}/documents.parquet")}, tmp_path_factory.mktemp("stages")
    docs = out["documents"]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{folder}/{name}")
        docs = out[name] = spark.read.parquet(f"{folder}/{name}")
    return {name: df.toPandas() for name, df in out.items()}


def test_stages_are_named_and_keep_the_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    for name in NAMES[:-1]:
        assert list(stages[name].columns) == list(stages["documents"].columns)


def test_each_stage_equals_its_brute_force(stages, spark):
    docs, known, unique = stages["documents"], stages["language"], stages["exact_dedup"]
    lettered = docs[docs.text.map(lambda t: any(map(str.isalpha, text_of(t))))]
    assert set(known.doc_id) <= set(lettered.doc_id) and len(known) > 0.99 * len(lettered)
    assert set(unique.doc_id) == set(known.groupby("text").doc_id.max())
    components, _ = brute_components(dict(zip(unique.doc_id, unique.text, strict=True)), 5, 80)
    apart = stages["near_dedup"]
    assert set(apart.doc_id) == set(components.values())
    frame = spark.createDataFrame(apart)
    taken = {r.doc_id: r.copies for r in mixing.plan(frame, queries.WEIGHTS).collect() if r.copies}
    assert Counter(stages["mix"].doc_id) == taken
    packed = stages["pack"]
    ends = packed.groupby("sequence_id").length.sum()
    assert ends.max() <= 4096 and np.arange(len(ends)).tolist() == sorted(ends.index)
    whole = packed[packed.start == 0].doc_id
    assert Counter(whole) == Counter(stages["mix"].doc_id)


def test_stages_on_edge_rows(docs, rows, spark, tmp_path):
    """Null and repeated ids, null and empty texts, extra columns of inner names."""
    known = corpus_pipeline.known_languages(spark, docs, SF)
    unique = corpus_pipeline.exact_copies(spark, docs, SF)
    assert known.columns == unique.columns == docs.columns
    assert Counter(text_of(r.text) for r in unique.select("text").collect()) == dict.fromkeys(map(text_of, rows.text), 1)
    unique.write.parquet(f"{tmp_path}/unique")
    apart = corpus_pipeline.near_copies(spark, spark.read.parquet(f"{tmp_path}/unique"), SF)
    assert apart.columns == docs.columns
    own = {r.doc_id: text_of(r.text) for r in unique.where("doc_id IS NOT NULL").select("doc_id", "text").collect()}
    components, sizes = brute_components(own, 5, 80)
    stay = {d for d, c in components.items() if d == c or not sizes[d]} | {None}
    got = [r.doc_id for r in apart.select("doc_id").collect()]
    assert sorted(got, key=str) == sorted(stay, key=str)
    mixed = corpus_pipeline.source_mix(spark, docs, SF)
    assert mixed.columns == docs.columns and mixed.where("doc_id IS NULL").count() <= 2
    packed = corpus_pipeline.packed(spark, docs, SF)
    assert packed.where("start = 0").count() == len(rows)


def test_stages_on_an_empty_table(docs, spark, tmp_path):
    empty = docs.where("false")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.count() == 0
        assert name == "pack" or out.columns == docs.columns


def test_without_labels_no_language_is_rejected(docs, rows, spark):
    kept = corpus_pipeline.known_languages(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_pipeline_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert names["pipeline"] is corpus_pipeline.run
    assert {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 14)}
    assert language.UNKNOWN == "und"
