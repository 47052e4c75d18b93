"""Similarity links inside candidate buckets, and the connected components they form.

Items that share a bucket key are candidates. First every item is compared with one leader, the smallest item of a
bucket, and buckets that lie in one component are settled. In those that remain, every item is compared with a leader
of another component, as long as many pairs are open. The pairs left in buckets of few items are compared once each,
whatever the number of buckets they share. The items of larger ones are compared in blocks: a task gets two blocks
of bounded size, their texts and what is joined already, looks at sketches first, and returns only links that join two
components. So a bucket of any size makes rows for its items and its blocks, never for its pairs, and no link between
different components is lost.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.buckets import keys_of, shared_keys
from broadsheet.llm.sketches import estimate, estimates
from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Pairs open in the buckets, for each of their rows, up to which all are compared in blocks.
PAIRS_A_ROW = 64

# Items of a bucket whose pairs are compared as rows, and items of a block of larger ones, about.
FEW = 16
BLOCK = 256

# Links that a task contracts at a time.
LINKS = 1 << 20

Shingles = Callable[[pa.Array], Iterator[np.ndarray]]


@dataclass(frozen=True)
class Similarity:
    """How items are compared.

    ``texts`` ``(item, text, sketch)`` is a written table; ``shingles`` gives the sorted distinct shingles of texts.
    Two items are linked if 100 times their shared shingles are ``at_least`` times all. Pairs whose sketches of
    so many ``hashes`` estimate a similarity below ``floor``, far below the threshold, are not linked.
    """

    texts: DataFrame
    shingles: Shingles
    at_least: int
    hashes: int
    floor: float

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of some pairs ``(a, b)`` that are linked: by their sketches, then on whole texts."""
        near = self._with(pairs, "sketch")
        near = near.where(estimate(F.col("sketch_a"), F.col("sketch_b"), self.hashes) >= self.floor).select("a", "b")
        linked = _linked(self.shingles, self.at_least)
        return self._with(near, "text").where(linked("text_a", "text_b")).select("a", "b")

    def _with(self, pairs: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            own = self.texts.select(F.col("item").alias(side), F.col(column).alias(f"{column}_{side}"))
            pairs = pairs.join(own, side)
        return pairs


def similar(a: np.ndarray, b: np.ndarray, at_least: int) -> bool:
    """Whether two sets of shingles are linked."""
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    if not len(a) or 100 * len(a) < at_least * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    shared = int(np.count_nonzero(b[at] == a))
    return 100 * shared >= at_least * (len(a) + len(b) - shared)


class Numbered:
    """Some sets of shingles, none of them empty, whose shingles are numbered once for all comparisons."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(one) for one in sets])
        self.starts = np.cumsum(self.sizes) - self.sizes
        different, self.numbers = np.unique(np.concatenate(sets), return_inverse=True)
        self.marked = np.zeros(len(different), dtype=bool)

    def of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of some sets, one after another, and where each begins."""
        sizes = self.sizes[chosen]
        begins = np.cumsum(sizes) - sizes
        return self.numbers[np.repeat(self.starts[chosen] - begins, sizes) + np.arange(sizes.sum())], begins

    def similar(self, a: int, others: np.ndarray, at_least: int) -> np.ndarray:
        """Which of some other sets are linked to one."""
        out = np.zeros(len(others), dtype=bool)
        # Sets of too different sizes cannot be linked.
        size, sizes = self.sizes[a], self.sizes[others]
        near = np.flatnonzero(100 * np.minimum(size, sizes) >= at_least * np.maximum(size, sizes))
        if len(near):
            own = self.numbers[self.starts[a] : self.starts[a] + size]
            self.marked[own] = True
            numbers, begins = self.of(others[near])
            shared = np.add.reduceat(self.marked[numbers], begins, dtype=np.int64)
            self.marked[own] = False
            out[near] = 100 * shared >= at_least * (size + sizes[near] - shared)
        return out


def _linked(shingles: Shingles, at_least: int):
    @F.arrow_udf("boolean")
    def linked(text_a: pa.Array, text_b: pa.Array) -> pa.Array:
        return pa.array([similar(a, b, at_least) for a, b in zip(shingles(text_a), shingles(text_b))], pa.bool_())

    return linked


def candidate_rows(listed: DataFrame, keys_each: int, work: Workspace) -> DataFrame:
    """``(key, item, leader)`` for all but the smallest item, the leader, of every bucket of ``listed``, a written
    table with the columns of :func:`buckets.keyed` and ``keys_each`` keys an item."""
    shared = work.keep(shared_keys(listed, keys_each))
    # A bucket of two is known by its smallest and largest item; only larger ones are looked up again.
    two = shared.where("n = 2").select("key", F.col("last").alias("item"), "leader")
    more = work.keep(shared.where("n > 2").select("key", "leader"))
    members = keys_of(listed, more).join(work.small(more), "key").where("item > leader").select("key", "item", "leader").distinct()
    return work.keep(two.union(members))


def link(active: DataFrame, similarity: Similarity, work: Workspace) -> DataFrame:
    """Links ``(a, b)`` that connect the items of :func:`candidate_rows`.

    They have the same components as the graph of all linked pairs that share a bucket.
    """
    # Every item first with the smallest of its leaders, which joins most of what is linked.
    tested = work.keep(active.groupBy("item").agg(F.min("leader").alias("a")).select("a", F.col("item").alias("b")))
    roots = components(similarity.links(tested), work)
    active = _mixed(active, roots, work)
    allowed, turn = max(1, active.count() * PAIRS_A_ROW), 0
    while True:
        pairs = active.select(F.least("leader", "item").alias("a"), F.greatest("leader", "item").alias("b")).distinct()
        pairs = work.keep(_apart(pairs, roots).join(tested, ["a", "b"], "left_anti"))
        tested = tested.union(pairs)
        roots = components(_joined(roots).union(similarity.links(pairs)), work)
        members = active.select("key", "item").union(active.select("key", F.col("leader").alias("item"))).distinct()
        members = work.keep(_with_root(members, roots, "item"))
        kinds = members.groupBy("key", "root_item").agg(F.count("*").cast("double").alias("n"), F.min("item").alias("first"))
        keys = kinds.groupBy("key").agg(
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs"),
            F.min_by("first", F.xxhash64("first", F.lit(turn))).alias("leader"),
        )
        keys = work.keep(keys.where("pairs > 0"))
        pairs_left = keys.agg(F.sum("pairs")).first()[0] or 0
        if pairs_left <= allowed:
            break
        allowed, turn = allowed * 2, turn + 1
        active = work.keep(members.join(keys, "key").where("item <> leader").select("key", "item", "leader"))
    found = _joined(roots)
    if not pairs_left:
        return found
    open_members = work.keep(members.join(work.small(keys.select("key")), "key"))
    return found.union(_compared(open_members, tested, similarity, work))


def _compared(members: DataFrame, tested: DataFrame, similarity: Similarity, work: Workspace) -> DataFrame:
    """Links between different components inside the buckets of ``members`` ``(key, item, root_item)``, without those
    among the pairs ``tested`` before."""
    prints = members.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("item")).alias("x"), F.bit_xor(F.xxhash64("item", F.lit(1))).alias("y")
    )
    # Buckets of the same items are one.
    keys = work.keep(prints.groupBy("n", "x", "y").agg(F.min("key").alias("key")))
    few = members.join(keys.where(F.col("n") <= FEW).select("key"), "key")
    x, y = few.alias("x"), few.alias("y")
    apart = F.expr("x.key = y.key and x.item < y.item and x.root_item <> y.root_item")
    pairs = x.join(y, apart).select(F.col("x.item").alias("a"), F.col("y.item").alias("b")).distinct()
    pairs = work.keep(pairs.join(tested, ["a", "b"], "left_anti"))
    return work.keep(similarity.links(pairs)).union(_in_blocks(members, keys.where(F.col("n") > FEW), similarity, work))


def _in_blocks(members: DataFrame, keys: DataFrame, similarity: Similarity, work: Workspace) -> DataFrame:
    """Links between different components inside the buckets ``(key, n)``, compared block by block."""
    rows = members.join(keys.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "key")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int"))
    rows = rows.join(similarity.texts, "item")
    # Each block meets every block of its bucket, itself included, in a task of the two.
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    group = ["key", "low", "high"]
    met = met.select(
        "key",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "item",
        F.col("root_item").alias("root"),
        "block",
        "text",
        "sketch",
    )
    met = met.repartition(*group).sortWithinPartitions(*group, "item")
    return work.keep(met.mapInArrow(_comparer(similarity), "a long, b long"))


def _comparer(similarity: Similarity):
    shingles, at_least = similarity.shingles, similarity.at_least
    hashes, floor = similarity.hashes, similarity.floor

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            found = list(_links_of(group, shingles, at_least, hashes, floor))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return compare


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each group of a sorted partition."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not len(table):
            continue
        ids = np.stack([table[name].to_numpy() for name in ("key", "low", "high")])
        begins = np.concatenate([[0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1])
        for begin, end in zip(begins, begins[1:]):
            yield table.slice(begin, end - begin)
        rest = table.slice(begins[-1])
    if rest is not None:
        yield rest


def _links_of(group: pa.Table, shingles: Shingles, at_least: int, hashes: int, floor: float) -> Iterator[tuple[int, int]]:
    """Links that join components of two blocks, or of one."""
    items, block = group["item"].to_numpy(), group["block"].to_numpy()
    texts = group["text"].combine_chunks()
    sketches = group["sketch"].combine_chunks().flatten().to_numpy().reshape(len(items), -1)
    component = np.unique(group["root"].to_numpy(), return_inverse=True)[1]
    # The pairs inside a block are for the task of the block with itself.
    across = group["low"][0].as_py() != group["high"][0].as_py()
    known: dict[int, np.ndarray] = {}
    for low in range(0, len(items), BLOCK):
        own = np.arange(low, min(low + BLOCK, len(items)))
        apart = (component[own][:, None] != component) & (own[:, None] < np.arange(len(items)))
        if across:
            apart &= block[own][:, None] != block
        i, j = np.nonzero(apart)
        near = estimates(sketches[own[i]], sketches[j], hashes) >= floor
        i, j = own[i[near]], j[near]
        new = [at for at in np.unique(np.concatenate([i, j])).tolist() if at not in known]
        known.update(zip(new, shingles(texts.take(pa.array(new, pa.int64())))))
        if not len(i):
            continue
        sets = Numbered([known[at] for at in range(len(items)) if at in known])
        number = np.cumsum([at in known for at in range(len(items))]) - 1
        for a in np.unique(i).tolist():
            others = j[i == a]
            others = others[component[others] != component[a]]
            for b in others[sets.similar(number[a], number[others], at_least)].tolist():
                if component[a] != component[b]:
                    yield int(min(items[a], items[b])), int(max(items[a], items[b]))
                    component[component == component[b]] = component[a]


def _joined(roots: DataFrame) -> DataFrame:
    """Links ``(a, b)`` with the components of ``roots``."""
    return roots.select(F.col("item").alias("a"), F.col("root").alias("b"))


def _mixed(active: DataFrame, roots: DataFrame, work: Workspace) -> DataFrame:
    """The rows of buckets that lie in several components; the others are settled."""
    rooted = _with_root(_with_root(active, roots, "item"), roots, "leader")
    keys = rooted.where("root_item <> root_leader").select("key").distinct()
    return work.keep(active.join(work.small(work.keep(keys)), "key", "left_semi"))


def _with_root(rows: DataFrame, roots: DataFrame, side: str) -> DataFrame:
    """``root_<side>``: the root of the item in a column; an item without links is its own."""
    root = roots.select(F.col("item").alias("__item"), F.col("root").alias("__root"))
    joined = rows.join(root, F.col(side) == F.col("__item"), "left")
    return joined.withColumn(f"root_{side}", F.coalesce("__root", side)).drop("__item", "__root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different components."""
    return _with_root(_with_root(pairs, roots, "a"), roots, "b").where("root_a <> root_b").select("a", "b")


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """``(item, root)`` for every item in a link ``(a, b)``; the root is the smallest item reachable.

    Distributed union-find: each task contracts its own links to stars. If these are no more than a task contracts
    at a time, one task joins them. Otherwise alternating star contraction does: every item's larger neighbours are
    hung on its smallest neighbour, then its smaller ones, until nothing moves. Each step is two aggregations that
    combine before the shuffle, and a join that splits skewed keys.
    """
    # Written first: if the comparisons ran in the stage of the contraction, each core would have two Python workers.
    links = work.keep(links.where("a <> b").select("a", "b"))
    edges = work.keep(links.mapInArrow(_stars, "u long, v long"))
    if edges.count() <= LINKS:
        few = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).coalesce(1)
        return _stars_as_roots(work.keep(few.mapInArrow(_stars, "u long, v long")))
    edges = work.keep(edges.distinct())
    state = _fingerprint(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hung = work.keep(large.where("u <> v").distinct())
        least = hung.groupBy("u").agg(F.min("v").alias("m"))
        small = hung.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = work.keep(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        work.forget(edges)
        work.forget(hung)
        edges, before = moved, state
        state = _fingerprint(edges)
        if state == before:
            break
    return _stars_as_roots(edges)


def _stars_as_roots(edges: DataFrame) -> DataFrame:
    roots = edges.select(F.col("u").alias("item"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("item"), F.col("v").alias("root")).distinct())


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(item, root)`` for the components of each ``LINKS`` links of a task."""
    parts, size = [], 0
    for batch in batches:
        parts.append((batch.column("a").to_numpy(), batch.column("b").to_numpy()))
        size += len(batch)
        if size >= LINKS:
            yield from _contract(parts)
            parts, size = [], 0
    if parts:
        yield from _contract(parts)


def _contract(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    ends = np.concatenate([np.concatenate(side) for side in zip(*parts)])
    items, at = np.unique(ends, return_inverse=True)
    a, b = at[: len(at) // 2], at[len(at) // 2 :]
    root = np.arange(len(items))
    while (apart := root[a] != root[b]).any():
        a, b = a[apart], b[apart]
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while ((up := root[root]) != root).any():
            root = up
    hung = np.flatnonzero(root != np.arange(len(items)))
    table = pa.Table.from_arrays([pa.array(items[hung]), pa.array(items[root[hung]])], names=["u", "v"])
    yield from table.to_batches(max_chunksize=1 << 16)


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())
