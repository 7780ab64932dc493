from __future__ import annotations

from collections import Counter

from ofertario.llm import mixing

from llm_helpers import text_of, words_of


def test_mix_keeps_null_and_repeated_ids(docs, spark):
    more = spark.createDataFrame(
        [(None, "a b c"), (None, "d e f"), (7, "one two"), (7, "three four"), (7, "five six")], "doc_id long, text string"
    )
    both = docs.unionByName(more, allowMissingColumns=True)
    planned, mixed = Counter(), Counter()
    for r in mixing.plan(both, [3, 1, 2]).collect():
        planned[(r.doc_id, r.source, r.size)] += r.copies
    for r in mixing.mix(both, [3, 1, 2]).collect():
        mixed[(r.doc_id, r.source, len(words_of(text_of(r.text))))] += 1
    assert mixed == Counter({k: n for k, n in planned.items() if n})
    assert any(k[0] is None for k in mixed)
