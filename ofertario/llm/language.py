"""Language ID by nearest centroids of TF-IDF vectors of character n-grams.

Letters, lower-cased, with runs of anything else as one space, give runs of one to
three characters, hashed into ``DIM`` places. Vectors are damped counts times
inverse document frequency, at length one. Each language has several centroids
from spherical k-means. A document gets the language of the centroid of largest
cosine and is rejected if that centroid's distance limit is exceeded.

The centroids are fitted on a bounded sample of labelled rows (``per_language`` of
each language in expectation, chosen by a hash of doc_id); they alone come to the
driver, as sparse counts.

Defined results: a text that is null or has no letter is ``und``, score 0, and is
rejected; rows without language teach nothing; without any labelled row all is
``und``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ofertario.llm.common import map_texts, only

DIM = 1 << 13
UNKNOWN = "und"


def letters_table() -> np.ndarray:
    """For code points below 0x3000: the code point of a letter, else a space."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x3000)], np.uint32)


def counts(text: str, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the hashed n-grams of a whole text."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    points = np.where(points < 0x3000, letters[np.minimum(points, 0x2FFF)], points)
    if (points != points[0]).any():
        space = points == 32
        points = points[~(space & np.r_[False, space[:-1]])]
    one = points * np.uint32(0x9E3779B1)
    two = (one[:-1] ^ (points[1:] * np.uint32(0x85EBCA77))) * np.uint32(0xC2B2AE3D)
    three = (two[:-1] ^ (points[2:] * np.uint32(0x27D4EB2F))) * np.uint32(0x165667B1)
    found = np.bincount(np.concatenate([one, two, three]) >> np.uint32(19), minlength=DIM)
    places = np.flatnonzero(found)
    return places, found[places]


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letters_table()
    for batch in batches:
        found = [counts(t, letters) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array([p.astype(np.int32) for p, _ in found], pa.list_(pa.int32())),
                pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32())),
            ],
            ["doc_id", "lang", "places", "found"],
        )


def _holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a task hold each n-gram's place."""
    letters, docs = letters_table(), np.zeros(DIM, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            docs[counts(text, letters)[0]] += 1
    places = np.flatnonzero(docs)
    yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(docs[places])], ["place", "docs"])


def held_out(doc_id: Column, of: int, rest: int) -> Column:
    """Whether crc32(doc_id as text) mod ``of`` is ``rest``; no doc_id: as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % of == rest


class Centroids:
    """Centroids at length one, their languages and least cosines."""

    def __init__(self, idf: np.ndarray, centres: np.ndarray, langs: list[str], least: np.ndarray):
        self.idf, self.centres, self.langs, self.least = idf, centres, langs, least

    def vector(self, places: np.ndarray, found: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(found)) * self.idf[places]
        return weights / (np.sqrt((weights * weights).sum()) or 1.0)


def spherical_means(vectors: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centres of unit vectors and the centre of each; starts from far points."""
    k = min(k, len(vectors))
    mean = vectors.mean(axis=0)
    picked = [int(np.argmax(vectors @ mean))]
    while len(picked) < k:
        picked.append(int(np.argmin((vectors @ vectors[picked].T).max(axis=1))))
    centres = vectors[picked].copy()
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        for c in range(k):
            if (own == c).any():
                total = vectors[own == c].sum(axis=0)
                centres[c] = total / (np.linalg.norm(total) or 1.0)
    return centres, np.argmax(vectors @ centres.T, axis=1)


def fit(
    docs: DataFrame,
    per_language: int = 400,
    per_centre: int = 4,
    leniency: float = 0.25,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Centroids | None:
    """Centroids from labelled rows; None where there are none. Document frequencies are
    counted over all of these rows; centroids are fitted on ``per_language`` of each
    language in expectation. A centroid accepts cosines down to ``leniency`` times the
    least one among its sample rows."""
    rows = only(docs, doc_id=id_col, text=text_col, lang=lang_col)
    rows = rows.where("lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    sizes = rows.groupBy("lang").count()
    chance = F.xxhash64("doc_id", "text") / F.lit(2.0**64) + 0.5
    sample = (
        rows.join(F.broadcast(sizes), "lang")
        .where(chance * F.col("count") < per_language)
        .select("doc_id", F.col("lang").cast("string").alias("lang"), "text")
    )
    kind = sample.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang string, places array<int>, found array<int>"
    got = map_texts(sample, _sparse, schema).orderBy("lang", "doc_id").collect()
    if not got:
        return None
    in_docs, total = np.zeros(DIM), sum(r["count"] for r in sizes.collect())
    holding = map_texts(rows.select("text"), _holding, "place int, docs long").groupBy("place")
    for row in holding.agg(F.sum("docs").alias("docs")).collect():  # a row for each of DIM places
        in_docs[row["place"]] = row["docs"]
    model = Centroids(np.log((1 + total) / (1 + in_docs)) + 0.1, np.zeros((0, DIM)), [], np.zeros(0))
    centres, langs, least = [], [], []
    for lang in sorted({r["lang"] for r in got}):
        own = [r for r in got if r["lang"] == lang]
        vectors = np.zeros((len(own), DIM), np.float32)
        for i, row in enumerate(own):
            places = np.array(row["places"])
            vectors[i, places] = model.vector(places, np.array(row["found"]))
        found, of = spherical_means(vectors, per_centre)
        near = (vectors * found[of]).sum(axis=1)
        centres.append(found)
        langs += [lang] * len(found)
        least += [leniency * near[of == c].min(initial=1.0) for c in range(len(found))]
    model.centres = np.concatenate(centres).astype(np.float32)
    model.langs, model.least = langs, np.array(least)
    return model


def _predict(model: Centroids | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letters_table()
        for batch in batches:
            langs, scores, rejected = [], [], []
            for text in batch.column("text").to_pylist():
                if model is None or not text or not any(map(str.isalpha, text)):
                    langs.append(UNKNOWN), scores.append(0.0), rejected.append(True)
                    continue
                places, found = counts(text, letters)
                near = model.centres[:, places] @ model.vector(places, found).astype(np.float32)
                best = int(np.argmax(near))
                langs.append(model.langs[best])
                scores.append(float(min(1.0, max(0.0, near[best]))))
                rejected.append(bool(near[best] < model.least[best]))
            out = [batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(rejected, pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"]
            )

    return predict


def predict(docs: DataFrame, model: Centroids | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score (cosine, 0 to 1), rejected."""
    cols = only(docs, doc_id=id_col, text=text_col)
    kind = cols.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    return map_texts(cols, _predict(model), schema)


def keep_known(docs: DataFrame, model: Centroids | None, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns: one pass, no join. Without a
    model nothing is known of any language, and all rows stay."""
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _predict(model)
        for batch in batches:
            n = batch.num_rows
            two = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), batch.column(at)], ["doc_id", "text"])
            (told,) = judge(iter([two]))
            known = [not r for r in told.column("rejected").to_pylist()]
            yield batch.filter(pa.array(known, pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return map_texts(plain, keep, plain.schema).toDF(*docs.columns)
