"""From raw documents to packed training sequences, in five stages.

Each stage gets what the one before kept, written as Parquet and read again. All but
the last return the columns of ``documents``, others that the table has included. An empty
table gives none at every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ofertario.llm import exact_dedup, jaccard, language, mixing, packing
from ofertario.llm.common import table
from ofertario.llm.queries import WEIGHTS
from ofertario.session import scratch, written
from ofertario.sources.tables import remove


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-centroid classifier does not reject.

    Null texts and texts without a letter go. Rows are judged one by one, whatever their
    ids. Where no row has a language nothing can be learned, and all rows stay."""
    return language.keep_known(docs, language.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id.

    A null text equals an empty one. Rows without doc_id come last; of rows that repeat
    the largest id with one text, one stays."""
    return exact_dedup.kept_rows(docs, exact_dedup.new_index(spark))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similarity 0.8 over five-word shingles connect, the
    one with the smallest doc_id.

    Rows go by id and text together: another text under a copy's id stays. Texts without
    words and rows without doc_id are linked with nothing and stay."""
    return jaccard.one_of_each(docs, words=5, percent=80, spare=12)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in its order.

    Rows are documents of their own, also those without doc_id and those that repeat one;
    a null source is a source; texts without words have size 0 and are served in turn."""
    return mixing.mix(docs, WEIGHTS, share=1.5, max_repeats=2)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where the pieces of each document lie in sequences of 4096 tokens.

    A null text is an empty one and gives the end token alone; repeated rows are documents
    of their own."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), keep_ids=False)


STAGES = [
    ("language", known_languages),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mix", source_mix),
    ("pack", packed),
]

#: SQL cannot tokenise or fit centroids; a brute-force version tests the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; what a stage wrote besides its result goes with it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folders: list[str] = []
        with scratch(folders):
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        for folder in folders[:-1]:
            remove(spark, folder)
    return STAGES[-1][1](spark, docs, sf_dir)
