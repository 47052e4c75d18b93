"""Rows per pass of a mix, even ranges of keys, and names that are in use."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.llm import mixing
from broadsheet.llm.tables import Workspace

SF_DIR = "/root/testdata/sf0.001"


def test_a_pass_is_a_row(spark):
    rows = [(1, " a b" * 5, "x", 20), (2, "b " * 1000, "y", 2000), (3, "c\n" * 5, None, 10), (4, None, "y", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    found = sorted(tuple(row) for row in mixing.epochs(docs).collect())
    assert found == [
        (1, " a b" * 5, "x", 20, 1), (1, " a b" * 5, "x", 20, 2), (1, " a b" * 5, "x", 20, 3),
        (2, ("b " * 970).rstrip(), "y", 1939, 1),
        (3, "c\n" * 5, None, 10, 1), (3, "c\n" * 5, None, 10, 2), (3, "c\n" * 5, None, 10, 3),
    ]


def test_passes_meet_the_targets_and_never_repeat_inside_a_text(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {row.doc_id: row.text for row in documents.collect()}
    targets = {row.source: row.target for row in mixing.mix(documents).collect()}
    words, seen = Counter(), set()
    for row in mixing.epochs(documents).collect():
        words[row.source] += len(re.findall(mixing.WORD, row.text))
        assert texts[row.doc_id].startswith(row.text) and row.n_chars == len(row.text)
        assert (row.doc_id, row.epoch) not in seen and 1 <= row.epoch <= mixing.MOST_EPOCHS
        seen.add((row.doc_id, row.epoch))
    assert all(abs(words[source] - target) < 1.001 for source, target in targets.items())


@pytest.mark.parametrize("weight", [0.05, 0.2, 1.0, 10.0, None])
def test_ranges_are_even_at_any_weight(spark, weight, monkeypatch):
    kept = []
    keep = Workspace.keep
    monkeypatch.setattr(Workspace, "keep", lambda self, df, *codec: kept.append(keep(self, df, *codec)) or kept[-1])
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.col("id"), F.lit("word")).alias("text"), F.lit("s").alias("source")
    )
    rate = F.when(F.col("doc_id") % 2 == 0, 0.01).otherwise(1.0) if weight is None else F.lit(weight)
    mixing.mix(docs, rate).count()
    drawn = next(df for df in kept if "range" in df.columns)
    sizes = [row["count"] for row in drawn.groupBy("range").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 200


def test_which_documents_are_taken_equals_sorting_all_keys(spark):
    """Brute force: keys from the hash, sorted per source, summed to the budget; with ties and repeated rows."""
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "source")
    documents = documents.union(documents.where("doc_id < 20"))
    hashed = documents.select(
        "*", F.xxhash64(F.lit(mixing.SEED), "doc_id", F.xxhash64("text")).alias("h"), mixing.quality(F.col("text")).alias("q"),
        mixing.n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("t"),
        (-F.log((F.shiftrightunsigned(F.xxhash64(F.lit(mixing.SEED), "doc_id", F.xxhash64("text")), 12).cast("double") + 0.5) / float(1 << 52)) / mixing.quality(F.col("text"))).alias("key"),
    ).collect()
    taken = Counter()
    targets = {row.source: (row.source_size, row.target) for row in mixing.mix(documents).collect()}
    for source, (size, target) in targets.items():
        own = sorted((row for row in hashed if row.source == source), key=lambda row: (row.key, row.doc_id, row.t))
        whole = min(int(target / size), mixing.MOST_EPOCHS) if size else 0
        left = int(target) - whole * size
        for row in own:
            part = max(0, min(row["size"], left))
            left -= part
            taken[row.doc_id] += whole * row["size"] + part
    found = Counter()
    for row in mixing.mix(documents).collect():
        found[row.doc_id] += row.taken
    assert found == taken


def test_names_in_use(spark, tmp_path):
    rows = [(1, "a b c", "x", 1, 2, 3), (2, "d e", "y", 4, 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int, Epochs_Taken int, words_taken int")
    passes, whole = mixing.epochs(docs), mixing.sample(docs)
    assert passes.columns[-1] == "epoch_" and whole.columns[-2:] == ["epochs_taken_", "words_taken_"]
    for i, df in enumerate((passes, whole)):
        df.write.parquet(str(tmp_path / str(i)))
