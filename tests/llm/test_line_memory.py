"""What a task of the line operator holds, and the steps that compare keys and sets."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import buckets, line_dedup, linking, tables


def test_rows_read_at_once_are_few(spark):
    spark.conf.set(tables.READ_SETTING, "4096")
    tables.Workspace(spark, "test")
    assert spark.conf.get(tables.READ_SETTING) == str(tables.BATCH_ROWS)


def test_kept_tables_have_small_groups(spark):
    work = tables.Workspace(spark, "test")
    rows = spark.range(20_000, numPartitions=1).select(
        "id", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(59)), lambda i: F.sha2(F.concat("id", i), 256)), "").alias("text")
    )
    kept = work.keep(rows, False)
    sizes = []
    for name in kept.inputFiles():
        about = pq.ParquetFile(name.removeprefix("file://")).metadata
        sizes += [about.row_group(i).total_byte_size for i in range(about.num_row_groups)]
    assert sum(sizes) > 3 * tables.GROUP_BYTES
    assert max(sizes) < 1.5 * tables.GROUP_BYTES
    assert kept.count() == 20_000


def test_shards_rise_with_the_key():
    random = np.random.default_rng(1)
    keys = np.sort(random.integers(-(1 << 63), (1 << 63) - 1, 50_000, dtype=np.int64))
    keys[0], keys[-1] = -(1 << 63), (1 << 63) - 1
    for shards in (1, 2, 7, 101, 100_003):
        found = buckets.shard_of(keys, shards)
        assert found.min() == 0 and found.max() == shards - 1
        assert (np.diff(found) >= 0).all()
    assert np.bincount(buckets.shard_of(keys, 7)).min() > 6_000


def test_keys_among_others():
    random = np.random.default_rng(2)
    keys = random.integers(-(1 << 63), (1 << 63) - 1, 20_000, dtype=np.int64)
    known = np.sort(np.concatenate([keys[::9], keys[::9] ^ 1, random.integers(-(1 << 40), 1 << 40, 500)]))
    assert (buckets.Among(known)(keys) == np.isin(keys, known)).all()
    assert not buckets.Among(known[:0])(keys).any()
    assert not len(buckets.Among(known)(keys[:0]))


def test_numbered_sets_are_compared_as_the_sets():
    random = np.random.default_rng(3)
    base = np.unique(random.integers(0, 1 << 62, 300, dtype=np.uint64))
    sets = [np.unique(np.concatenate([base[random.random(len(base)) < share], random.integers(0, 1 << 62, 9, dtype=np.uint64)]))
            for share in (0.0, 0.3, 0.8, 0.85, 0.9, 0.95, 1.0, 1.0)] * 3
    numbered = linking.Numbered(sets)
    others = np.arange(len(sets))
    linked = 0
    for a in others.tolist():
        found = numbered.similar(a, others, 80).tolist()
        assert found == [linking.similar(sets[a], b, 80) for b in sets]
        linked += sum(found)
    assert len(sets) < linked < len(sets) ** 2
    assert not len(numbered.similar(0, others[:0], 80))


@pytest.mark.parametrize("every", [False, True])
def test_texts_without_a_word(spark, every):
    rows = [(1, None), (2, ""), (3, " \n\t\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = {row.doc_id: (row.text, row.n_lines, row.n_dropped) for row in line_dedup.dedup_lines(docs, every=every).collect()}
    assert found == {1: (None, 0, 0), 2: ("", 1, 0), 3: (" \n\t\n", 3, 0)}
