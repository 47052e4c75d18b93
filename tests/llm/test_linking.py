"""Packed band keys and contracted links against plain dictionaries."""

import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

from broadsheet.llm import buckets, linking, sketches, words
from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_shared_keys_equal_brute_force(monkeypatch):
    monkeypatch.setattr(buckets, "CHUNK", 50)
    random = np.random.default_rng(1)
    items, keys = random.integers(-50, 50, 300), random.integers(-200, 200, (300, 4))
    keys[:100, 0] = 7  # a hot key

    def batch(low, high):
        listed = pa.array(keys[low:high].tolist(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(items[low:high]), listed], names=["item", "keys"])

    shards = defaultdict(list)
    for packed in buckets._pack(5)(iter([batch(0, 100), batch(100, 101), batch(101, 300)])):
        for row in packed.to_pylist():
            shards[row["shard"]].append(row["entries"])
    found = {}
    for entries in shards.values():
        packed = pa.RecordBatch.from_arrays([pa.array(entries, pa.binary())], names=["entries"])
        for merged in buckets._merge(iter([packed])):
            found |= {row["key"]: (row["leader"], row["last"], row["n"]) for row in merged.to_pylist()}
    members = defaultdict(list)
    for item, own in zip(items.tolist(), keys.tolist()):
        for key in own:
            members[key].append(item)
    assert found == {k: (min(m), max(m), len(m)) for k, m in members.items() if min(m) < max(m)}


def test_nothing_is_shared_by_nothing():
    assert list(buckets._merge(iter([]))) == []


def test_contracted_links_keep_components():
    random = np.random.default_rng(0)
    for _ in range(50):
        a, b = random.integers(-100, 300, (2, random.integers(1, 200)))
        found = {}
        for stars in linking._contract([(a, b)]):
            found |= dict(zip(stars["u"].to_pylist(), stars["v"].to_pylist()))
        parent = {}

        def root(x):
            parent.setdefault(x, x)
            while parent[x] != x:
                x = parent[x]
            return x

        for x, y in zip(a.tolist(), b.tolist()):
            x, y = root(x), root(y)
            parent[max(x, y)] = min(x, y)
        assert found == {x: root(x) for x in parent if root(x) != x}


def keys_in_bytes(items, keys):
    data = [np.array(own, dtype=np.int64).tobytes() for own in keys]
    listed = pa.array(items, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays([listed, pa.array(data, pa.binary())], names=["items", "keys"])


def test_keys_as_bytes_are_those_of_their_items():
    batch = keys_in_bytes([[5, 7], [], [9]], [[[1, 2], [3, 4]], [], [[5, 6]]])
    for part, expected in ((batch, ([5, 5, 7, 7, 9, 9], [1, 2, 3, 4, 5, 6])), (batch.slice(2), ([9, 9], [5, 6])), (batch.slice(1, 1), ([], []))):
        items, keys = buckets.keyed(part)
        assert (items.tolist(), keys.tolist()) == expected


def made_corpus(seed, n, shingles=60):
    """Sets of numbers as texts, in families whose members lie near the threshold."""
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        family = np.random.default_rng(i % 7).permutation(1000)[:shingles] + 1
        own = random.integers(2000, 100_000, shingles)
        keep = random.random(shingles) < random.choice([0.75, 0.85, 0.9, 0.95, 1.0])
        rows.append((i, " ".join(map(str, np.where(keep, family, own)))))
    return rows


def number_sets(texts):
    for text in texts.to_pylist():
        yield np.unique(np.array(text.split(), dtype=np.uint64))


@pytest.mark.parametrize("few, block, pairs_a_row", [(16, 256, 64), (0, 256, 64), (0, 5, 64), (3, 4, 0), (1000, 256, 0)])
def test_links_of_buckets_equal_all_pairs(spark, monkeypatch, few, block, pairs_a_row):
    """One bucket holds everything, others parts of it; pairs as rows, blocks, and several leaders give the same."""
    for name, value in (("FEW", few), ("BLOCK", block), ("PAIRS_A_ROW", pairs_a_row)):
        monkeypatch.setattr(linking, name, value)
    rows = made_corpus(3, 90)
    sets = dict(zip((i for i, _ in rows), number_sets(pa.array([text for _, text in rows]))))
    buckets_of = {0: list(sets), 1: list(range(0, 90, 2)), 2: list(range(30)), 3: list(range(30)), 4: [3, 10], 5: [80, 87, 3]}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            both = len(np.intersect1d(sets[i], sets[j]))
            if i < j and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    factors = np.random.default_rng(1).integers(0, 1 << 31, 128, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    least = {i: (np.array([words.mix(s)]).astype(np.uint32) * factors[:, None]).min(axis=1) for i, s in sets.items()}
    texts = [(i, text, sketches.pack(least[i]).tolist()) for i, text in rows]
    work = Workspace(spark, "t")
    similarity = linking.Similarity(
        work.keep(spark.createDataFrame(texts, "item long, text string, sketch array<long>")), number_sets, 75, 128, 0.4
    )
    active = [(key, i, min(own)) for key, own in buckets_of.items() for i in own if i != min(own)]
    active = work.keep(spark.createDataFrame(active, "key long, item long, leader long").repartition(3))
    found = {row.item: row.root for row in linking.components(linking.link(active, similarity, work), work).collect()}
    assert {i: found.get(i, i) for i in sets} == {i: root(i) for i in sets}
    assert 7 <= len(set(map(root, sets))) < 60


@pytest.mark.parametrize("links", [1 << 20, 3])
def test_components_in_one_task_and_in_many(spark, monkeypatch, links):
    monkeypatch.setattr(linking, "LINKS", links)
    random = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in random.integers(0, 60, (45, 2))]
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    found = {row.item: row.root for row in linking.components(df, Workspace(spark, "t")).collect()}
    parent = {x: x for edge in edges for x in edge}
    for _ in range(60):
        for a, b in edges:
            parent[a] = parent[b] = min(parent[a], parent[b])
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert found == {x: parent[x] for x in linked}
