"""The texts of a mix hold the words it takes."""

import re
from collections import Counter

from broadsheet.llm import mixing

SF_DIR = "/root/testdata/sf0.001"


def test_a_mix_holds_the_words_it_takes(spark):
    rows = [(1, " a b" * 5, "x", 20), (2, "b " * 1000, "y", 2000), (3, "c\n" * 5, None, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = mixing.sample(docs).collect()
    assert {r.doc_id: r.epochs_taken for r in found} == {1: 3, 2: 0, 3: 3} and len(found) == 3
    targets = {r.doc_id: r.target for r in mixing.mix(docs).collect()}
    for i, target in targets.items():
        assert sum(len(r.text.split()) for r in found if r.doc_id == i) == int(target)
    assert all(r.words_taken == len(r.text.split()) and r.n_chars == len(r.text) for r in found)
    assert next(r.text for r in found if r.doc_id == 2) == ("b " * 970).rstrip()


def test_words_of_a_mix_meet_the_targets(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    targets = {r.source: r.target for r in mixing.mix(documents).collect()}
    words = Counter()
    for r in mixing.sample(documents).collect():
        words[r.source] += len(re.findall(mixing.WORD, r.text))
    assert all(abs(words[s] - target) < 1.001 for s, target in targets.items())
