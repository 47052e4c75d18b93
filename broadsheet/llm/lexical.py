"""Ranked lexical search with per-term geometric blocking.

Documents are indexed where they lie: a task takes some thousand of them at a time as a shard, so no posting list is
ever moved or gathered, however many documents hold its term. In a shard the posting list of a term is clustered
by the similarity of its documents, each to the nearest of some documents of the list, and every block of the
clustering keeps a summary: for each term the largest contribution any of its documents has.

Terms are taken by falling weight. A document of a list that holds none of an item's earlier terms can score at
most the sum of the summary over the item's remaining terms; if that is below the score of the item's last place
so far, the block is skipped, else its documents are scored. A whole list goes by the same bound before it is
clustered. Bounds are exact, so nothing that belongs to the result is ever skipped. The best of all shards of a
task, kept from shard to shard, are merged.

Postings hold terms of the items alone, as no other term is ever looked up; a large set of items is searched in
blocks, so that what is broadcast has a bound. Terms are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm import words
from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PLACES = 50
# Per cent: how far the length of a document counts.
LENGTH_SHARE = 50

# A shard has so many documents, and fewer where they hold more than so many postings.
SHARD_DOCS, SHARD_POSTINGS = 4096, 1 << 20
# Documents of a shard that may be centres, and the size of a list that is worth clustering.
CENTRES, SMALL_LIST = 64, 32
# Summary cells made at a time.
CELLS = 1 << 22

# Item terms searched for at a time: 16 bytes each are broadcast. An item of more terms is a block of its own.
TERMS_A_BLOCK = 1 << 20
# The places of an item are cut per group of tasks before they meet.
GROUPS = 32

POSTINGS = "n long, terms array<int>, counts array<int>"


@dataclass(frozen=True)
class Queries:
    """Items as rows of term numbers, in the order of the terms; a term's number is its place by hash."""

    hashes: np.ndarray
    terms: np.ndarray
    starts: np.ndarray


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, all their terms, and the weight of each term of the items."""

    n_docs: int
    n_terms: int
    weights: np.ndarray


def _term_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices of a batch: first row, hashes of the terms, and where each text's terms begin."""
    for low, part in words.slices(column):
        data, offsets = words.text_bytes(part)
        starts, stops, first = words.word_spans(data, offsets, words.ALNUM_OR_WIDE)
        yield low, words.word_hashes(data, starts, stops, words.FOLDED_VALUES), first


def _distinct_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low, hashes, first in _term_hashes(batch.column("text")):
            row = np.repeat(np.arange(len(first) - 1), np.diff(first)) + low
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_id").take(pa.array(row)), pa.array(hashes.view(np.int64))], names=["item_id", "term"]
            )


def item_terms(items: DataFrame) -> DataFrame:
    """``(item_id, term)``, each distinct term of each item once."""
    kind = items.schema["item_id"].dataType.simpleString()
    texts = items.select("item_id", F.col("text").cast("string"))
    return texts.mapInArrow(_distinct_terms, f"item_id {kind}, term long").distinct()


def _postings(hashes: Broadcast):
    """Numbered terms of the items in each document, and how often."""

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = hashes.value
        for batch in batches:
            for low, found, first in _term_hashes(batch.column("text")):
                place = np.minimum(np.searchsorted(known, found), len(known) - 1)
                hit = np.flatnonzero(known[place] == found)
                row = np.searchsorted(first, hit, side="right") - 1
                cell, counts = np.unique(row * len(known) + place[hit], return_counts=True)
                texts = len(first) - 1
                stops = np.searchsorted(cell, np.arange(texts + 1) * len(known)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, texts),
                        pa.array(np.diff(first).astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array((cell % len(known)).astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(stops), pa.array(counts.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "counts"],
                )

    return postings


def _frequencies(n_terms: int):
    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, dtype=np.int64)
        for batch in batches:
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(df[held])], names=["term", "df"])

    return frequencies


def contributions(terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """What each posting adds to a score; ``lengths`` are those of its document."""
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * corpus.n_docs) // corpus.n_terms
    return corpus.weights[terms] * ((1_000_000_000 * counts) // (1000 * counts + 20 * m))


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of several runs, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(begins - before, lengths) + np.arange(int(lengths.sum()))


class Shard:
    """Documents of a task: rows of postings, and the posting list of each term."""

    def __init__(self, ids: list, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int):
        self.ids, self.starts, self.terms, self.values, self.n_terms = ids, starts, terms, values, n_terms
        self.rows = np.repeat(np.arange(len(ids)), np.diff(starts))
        order = np.argsort(terms, kind="stable")
        self.list_docs, self.list_values = self.rows[order], values[order]
        self.list_starts = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.largest = np.zeros(n_terms, dtype=np.int64)
        held = np.flatnonzero(np.diff(self.list_starts))
        if len(held):
            self.largest[held] = np.maximum.reduceat(self.list_values, self.list_starts[held])
        self.likeness: np.ndarray | None = None

    def docs_of(self, term: int) -> np.ndarray:
        return self.list_docs[self.list_starts[term] : self.list_starts[term + 1]]

    def postings_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The postings of some documents, and how many each has."""
        lengths = self.starts[docs + 1] - self.starts[docs]
        return _runs(self.starts[docs], lengths), lengths

    def _centres(self) -> np.ndarray:
        """Likeness of every document to each centre: the product of their contributions, by length of the centre."""
        if self.likeness is None:
            n = min(CENTRES, len(self.ids))
            self.centres = np.unique(np.linspace(0, len(self.ids) - 1, n).astype(np.int64))
            self.likeness = np.zeros((len(self.ids), len(self.centres)), dtype=np.float32)
            for column, centre in enumerate(self.centres):
                own = slice(self.starts[centre], self.starts[centre + 1])
                weights = np.zeros(self.n_terms)
                norm = np.sqrt((self.values[own].astype(float) ** 2).sum())
                weights[self.terms[own]] = self.values[own] / (norm or 1.0)
                product = weights[self.terms] * self.values
                self.likeness[:, column] = np.bincount(self.rows, product, minlength=len(self.ids))
        return self.likeness

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a term's list, block after block, and where the blocks begin."""
        docs = self.docs_of(term)
        if len(docs) <= SMALL_LIST:
            return docs, np.zeros(1, dtype=np.int64)
        likeness = self._centres()
        own = np.flatnonzero(np.isin(self.centres, docs, assume_unique=True))
        if not len(own):
            own = np.arange(len(self.centres))
        nearest = likeness[np.ix_(docs, own)].argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        return docs[order], np.flatnonzero(np.diff(nearest[order], prepend=-1))

    def summaries(self, docs: np.ndarray, begins: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """Per block (rows) the largest contribution to each of the terms ``columns``."""
        column_of = np.full(self.n_terms, -1)
        column_of[columns] = np.arange(len(columns))
        at, lengths = self.postings_of(docs)
        block = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(docs))))
        column, row = column_of[self.terms[at]], np.repeat(block, lengths)
        asked = column >= 0
        cell, value = row[asked] * len(columns) + column[asked], self.values[at[asked]]
        out = np.zeros((len(begins), len(columns)), dtype=np.int64)
        np.maximum.at(out.reshape(-1), cell, value)
        return out


class Search:
    """The best documents of each item so far."""

    def __init__(self, queries: Queries, corpus: Corpus, places: int):
        self.queries, self.corpus, self.places = queries, corpus, places
        n_items = len(queries.starts) - 1
        # Terms by falling weight; an item's terms in that order, and the items of each term with its place there.
        self.rank = np.empty(len(corpus.weights), dtype=np.int64)
        self.rank[np.argsort(-corpus.weights, kind="stable")] = np.arange(len(corpus.weights))
        item = np.repeat(np.arange(n_items), np.diff(queries.starts))
        order = np.lexsort((self.rank[queries.terms], item))
        self.ordered = queries.terms[order]
        by_term = np.argsort(self.ordered, kind="stable")
        self.users, self.user_places = item[by_term], by_term
        self.user_starts = np.searchsorted(self.ordered[by_term], np.arange(len(corpus.weights) + 1))
        self.scores: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * n_items
        self.found: list[list] = [[]] * n_items
        self.least = np.zeros(n_items, dtype=np.int64)
        self.scored = self.skipped = 0

    def add(self, shard: Shard) -> None:
        """Search one shard."""
        starts, ordered = self.queries.starts, self.ordered
        most = shard.largest[ordered]
        totals = np.concatenate([[0], np.cumsum(most)])
        # At an item's term: the most a document without the item's earlier terms can score.
        rest = totals[np.repeat(starts[1:], np.diff(starts))] - totals[:-1]
        considered = np.zeros((len(starts) - 1, len(shard.ids)), dtype=bool)
        held = np.flatnonzero(np.diff(shard.list_starts) * np.diff(self.user_starts))
        wanted = np.zeros(len(self.corpus.weights), dtype=bool)
        for term in held[np.argsort(self.rank[held])]:
            users = slice(self.user_starts[term], self.user_starts[term + 1])
            items, places = self.users[users], self.user_places[users]
            # Equal scores may still win by doc_id.
            live = rest[places] >= np.maximum(self.least[items], 1)
            if not live.any():
                continue
            items, places = items[live], places[live]
            docs, begins = shard.blocks(term)
            ends = starts[items + 1]
            columns = np.unique(ordered[_runs(places, ends - places)])
            column_of = np.searchsorted(columns, ordered)  # right where an item's own terms are asked for
            step = max(1, CELLS // len(columns))
            for low in range(0, len(begins), step):
                chunk = begins[low : low + step]
                stop = begins[low + step] if low + step < len(begins) else len(docs)
                some, chunk = docs[chunk[0] : stop], chunk - chunk[0]
                summary = shard.summaries(some, chunk, columns)
                sizes = np.diff(np.append(chunk, len(some)))
                for item, place, end in zip(items, places, ends):
                    bound = summary[:, column_of[place:end]].sum(axis=1)
                    passed = np.repeat(bound >= max(self.least[item], 1), sizes)
                    new = some[passed & ~considered[item, some]]
                    self.skipped += int((~passed).sum())
                    # A skipped document cannot rank, and those before have been scored: neither comes again.
                    considered[item, some] = True
                    if len(new):
                        wanted[ordered[starts[item] : end]] = True
                        self._score(item, new, shard, wanted)
                        wanted[ordered[starts[item] : end]] = False

    def _score(self, item: int, docs: np.ndarray, shard: Shard, wanted: np.ndarray) -> None:
        at, lengths = shard.postings_of(docs)
        totals = np.concatenate([[0], np.cumsum(np.where(wanted[shard.terms[at]], shard.values[at], 0))])
        stops = np.cumsum(lengths)
        score = totals[stops] - totals[stops - lengths]
        self.scored += len(docs)
        good = np.flatnonzero(score >= max(self.least[item], 1))
        if not len(good):
            return
        scores = np.concatenate([self.scores[item], score[good]])
        found = self.found[item] + [shard.ids[i] for i in docs[good]]
        if len(scores) > self.places:
            # Null ids come last among equals.
            order = sorted(range(len(scores)), key=lambda i: (-scores[i], found[i] is None, found[i]))[: self.places]
            scores, found = scores[order], [found[i] for i in order]
        self.scores[item], self.found[item] = scores, found
        if len(scores) == self.places:
            self.least[item] = scores.min()


def _searched(queries: Broadcast, corpus: Broadcast, places: int):
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, kind, waiting, docs, postings = Search(queries.value, corpus.value, places), None, [], 0, 0
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            counts = np.diff(batch.column("terms").offsets.to_numpy()) if len(batch) else np.zeros(0, dtype=np.int64)
            totals, low = np.cumsum(counts), 0
            while low < len(batch):
                # As many rows as the shard still takes, one at least.
                before = totals[low - 1] if low else 0
                fit = int(np.searchsorted(totals, before + SHARD_POSTINGS - postings, side="right"))
                high = min(len(batch), max(low + 1, min(fit, low + SHARD_DOCS - docs)))
                waiting.append(batch.slice(low, high - low))
                docs, postings = docs + high - low, postings + int(totals[high - 1] - before)
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS or high < len(batch):
                    search.add(_shard(waiting, corpus.value))
                    waiting, docs, postings = [], 0, 0
                low = high
        if waiting:
            search.add(_shard(waiting, corpus.value))
        item = np.repeat(np.arange(len(search.scores)), [len(scores) for scores in search.scores])
        if len(item):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(item),
                    pa.array([doc for found in search.found for doc in found], kind),
                    pa.array(np.concatenate(search.scores)),
                ],
                names=["item", "doc_id", "score"],
            )

    return searched


def _shard(batches: list[pa.RecordBatch], corpus: Corpus) -> Shard:
    table = pa.Table.from_batches(batches).combine_chunks()
    terms = table["terms"].combine_chunks()
    lengths = terms.value_lengths().to_numpy()
    flat, counts = terms.flatten().to_numpy(), table["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
    values = contributions(flat, counts, np.repeat(table["n"].to_numpy(), lengths), corpus)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return Shard(table["doc_id"].to_pylist(), starts, flat, values, len(corpus.weights))


def _weights(df: dict[int, int], n_docs: int, n_terms: int) -> np.ndarray:
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(term, 0) + 1))) for term in range(n_terms)],
        dtype=np.int64,
    )


def search(docs: DataFrame, items: DataFrame, places: int = PLACES, label: str = "lexical") -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the best ``places`` rows of ``docs`` ``(doc_id, text, ...)`` for each item
    of ``items`` ``(item_id, text, ...)``; equal scores by doc_id, null last, and then as it comes.

    Null, empty and termless texts are in no result, as documents and as items. Rows of one item_id, null included,
    are one item with the terms of all. Every row of ``docs`` is a document of its own, so a doc_id that stands in
    several rows may fill several places. Other columns are ignored. Without documents or items there are no rows.
    """
    work = Workspace(docs.sparkSession, label)
    listed = work.keep(item_terms(items))
    blocks = max(1, math.ceil(listed.count() / TERMS_A_BLOCK))
    results = None
    for block in range(blocks):
        part = listed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else listed
        found = _search_block(docs, part, places, work)
        results = found if results is None else results.union(found)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return results.select("item_id", "rank", F.col("doc_id").cast(kind).alias("doc_id"), "score")


def _search_block(docs: DataFrame, listed: DataFrame, places: int, work: Workspace) -> DataFrame:
    spark = docs.sparkSession
    asked = listed.toArrow()
    names = asked["item_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    numbers = names.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    hashes, terms = np.unique(asked["term"].to_numpy().view(np.uint64), return_inverse=True)
    order = np.argsort(numbers, kind="stable")
    starts = np.searchsorted(numbers[order], np.arange(len(names.dictionary) + 1))
    item_type, doc_type = (df.schema[c].dataType.simpleString() for df, c in ((listed, "item_id"), (docs, "doc_id")))
    if not len(hashes):
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score long")
    known = spark.sparkContext.broadcast(hashes)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    postings = work.keep(texts.mapInArrow(_postings(known), f"doc_id {doc_type}, {POSTINGS}").where("n > 0"))
    n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = postings.select("terms").mapInArrow(_frequencies(len(hashes)), "term long, df long")
    df = dict(held.groupBy("term").agg(F.sum("df")).collect())
    queries = spark.sparkContext.broadcast(Queries(hashes, terms[order].astype(np.int64), starts))
    corpus = spark.sparkContext.broadcast(Corpus(n_docs, n_terms, _weights(df, n_docs, len(hashes))))
    found = postings.mapInArrow(_searched(queries, corpus, places), f"item long, doc_id {doc_type}, score long")
    # First the best of each group of tasks, then of all, so that no task gets the places of all others at once.
    found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
    for group in (["item", "part"], ["item"]):
        best = Window.partitionBy(*group).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= places)
    listed_names = pa.table({"item": pa.array(np.arange(len(names.dictionary))), "item_id": names.dictionary})
    named = spark.createDataFrame(listed_names)
    named = work.keep(named.select("item", F.col("item_id").cast(item_type).alias("item_id")))
    return found.join(work.small(named), "item").select("item_id", "rank", "doc_id", "score")
