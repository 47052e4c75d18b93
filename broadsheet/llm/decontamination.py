"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words are numbered and all items go into one automaton. Document words stream through it; the
state tells the longest item passage that ends at each word. Words inside an occurrence of a window (ten
consecutive item words, or a whole shorter item) are hit.

The automaton is broadcast. Its size follows the benchmark only and is checked before it is built: items are
dealt into as many automata as keep each below ``MAX_WORDS`` words, and the documents stream through all.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm import words
from broadsheet.llm.tables import Workspace, bound_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 10  # words
MAX_WORDS = 400_000  # words of one automaton: about 300 MB as Python objects

# What the cleaning removes: passages of at least so many words; a document goes as a whole when more than this
# share of its words is hit.
MIN_SPAN = WINDOW
MAX_COVERAGE = 0.8

# Fixed value: a word of the overlap rule, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SPAN_NAMES = ("first", "last", "start", "stop")
SPAN = pa.struct([(name, pa.int64()) for name in SPAN_NAMES])
KINDS = {
    "n_words": pa.int64(),
    "n_hit": pa.int64(),
    "longest": pa.int64(),
    "item_ids": pa.list_(pa.int64()),
    "spans": pa.list_(SPAN),
}
_SPANS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in SPAN_NAMES]))
FOUND = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "n_hit", "longest")]
    + [T.StructField("item_ids", T.ArrayType(T.LongType())), T.StructField("spans", _SPANS)]
)


class Automaton:
    """Generalised suffix automaton over the word numbers of items."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items = [(item, hashes) for item, hashes in items if len(hashes)]
        known = [hashes for _, hashes in self.items]
        self.vocabulary = np.unique(np.concatenate(known)) if known else np.zeros(0, dtype=np.uint64)
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = [(item, np.searchsorted(self.vocabulary, hashes).tolist()) for item, hashes in self.items]
        for _, sequence in numbered:
            last = 0
            for word in sequence:
                last = self._extend(last, word)
        self._mark(numbered)

    def _extend(self, last: int, word: int) -> int:
        """The state of the item's prefix with ``word`` appended."""
        following, link, length = self.next, self.link, self.length
        there = following[last].get(word)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._clone(last, word, there)
        new = self._state({}, length[last] + 1)
        state = last
        while state != -1 and word not in following[state]:
            following[state][word] = new
            state = link[state]
        if state == -1:
            link[new] = 0
        else:
            there = following[state][word]
            link[new] = there if length[there] == length[state] + 1 else self._clone(state, word, there)
        return new

    def _clone(self, state: int, word: int, there: int) -> int:
        following, link, length = self.next, self.link, self.length
        copy = self._state(dict(following[there]), length[state] + 1)
        link[copy], link[there] = link[there], copy
        while state != -1 and following[state].get(word) == there:
            following[state][word] = copy
            state = link[state]
        return copy

    def _state(self, following: dict[int, int], length: int) -> int:
        self.next.append(following)
        self.link.append(0)
        self.length.append(length)
        return len(self.next) - 1

    def _mark(self, numbered: list[tuple[int, list[int]]]) -> None:
        """Per state, the windows that every match reaching it ends with: their length and their items."""
        link, length = self.link, self.length
        at: dict[int, dict[int, set[int]]] = {}
        for item, sequence in numbered:
            size = min(WINDOW, len(sequence))
            state = 0
            for position, word in enumerate(sequence, 1):
                state = self.next[state][word]
                if position >= size:
                    window = state
                    while length[link[window]] >= size:
                        window = link[window]
                    at.setdefault(window, {}).setdefault(size, set()).add(item)
        # A state inherits the windows of its suffix links; shorter states come first.
        self.windows: list[tuple] = [()] * len(length)
        for state in sorted(range(1, len(length)), key=length.__getitem__):
            own = tuple((size, frozenset(items)) for size, items in at.get(state, {}).items())
            self.windows[state] = own + self.windows[link[state]] if link[state] > 0 else own
        self.shortest = min((len(sequence) for _, sequence in numbered), default=1)
        self.shortest = min(self.shortest, WINDOW)

    def tables(self) -> tuple:
        """Plain values, so that a task needs no copy of this package to read them."""
        return self.vocabulary, self.next, self.link, self.length, self.windows, self.shortest


def scan(tables: tuple, hashes: np.ndarray) -> tuple[np.ndarray, set[int], int]:
    """Which words are hit, the items with an occurring window, and the longest passage."""
    vocabulary, following, link, length, windows, shortest = tables
    hit = np.zeros(len(hashes), dtype=bool)
    found: set[int] = set()
    longest = 0
    if not len(vocabulary):
        return hit, found, longest
    number = np.searchsorted(vocabulary, hashes)
    number[number == len(vocabulary)] = 0
    known = vocabulary[number] == hashes
    # A word of no item takes the automaton back to its first state, so runs of known words stream alone,
    # and a run shorter than every window holds none.
    edges = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]])))
    for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist()):
        if stop - start < shortest:
            continue
        state = matched = 0
        for position, word in enumerate(number[start:stop].tolist(), start + 1):
            step = following[state].get(word)
            while step is None and state:
                state = link[state]
                matched = length[state]
                step = following[state].get(word)
            if step is not None:
                state = step
                matched += 1
            if matched > longest:
                longest = matched
            for size, items in windows[state]:
                if size <= matched:
                    hit[position - size : position] = True
                    found |= items
    return hit, found, longest


def item_words(column: pa.Array) -> list[np.ndarray]:
    data, offsets = words.text_bytes(column)
    starts, stops, first = words.word_spans(data, offsets, words.ALNUM_OR_WIDE)
    hashes = words.word_hashes(data, starts, stops, words.FOLDED_VALUES)
    return [hashes[low:high] for low, high in zip(first[:-1], first[1:])]


def automata(items: DataFrame) -> Iterator[Broadcast]:
    """Broadcast automata of ``(item_id, text)``, one after another.

    Items without words have no window. Rows that share an id, null included, are parts of one item.
    """
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    total = items.agg(F.sum(F.regexp_count(F.lower("text"), F.lit(WORD)))).first()[0] or 0
    parts = max(1, -(-total // MAX_WORDS))
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        table = mine.toArrow()
        listed = list(zip(table["item_id"].to_pylist(), item_words(table["text"].combine_chunks())))
        yield spark.sparkContext.broadcast(Automaton(listed).tables())


def overlaps(docs: DataFrame, items: DataFrame, found: str = "found") -> DataFrame:
    """All columns of ``docs`` and a struct ``found``: the words of the text, those hit, the longest passage,
    the ids of the items with occurring windows, and the hit passages as ranges of words and of UTF-8 bytes.

    Null and empty texts, and texts without a word, have none of these. No row is dropped or repeated, also
    when there are no items or no documents; other columns pass through (``found`` must be a free name).
    """
    bound_batches(docs.sparkSession)
    shared = automata(items)
    docs = docs.withColumn(found, _scanner(next(shared))(F.col("text").cast("string")))
    work = None
    for more in shared:
        # One automaton at a time: what is found so far is written before the next one is read.
        work = work or Workspace(docs.sparkSession, "decontamination")
        both = merged(F.col(found), _scanner(more)(F.col("text").cast("string")))
        docs = work.keep(docs.withColumn(found, both))
    return docs


def _scanner(shared: Broadcast) -> Callable:
    @F.arrow_udf(FOUND)
    def scan_texts(texts: pa.Array) -> pa.Array:
        tables = shared.value
        rows = []
        for _, part in words.slices(texts):
            data, offsets = words.text_bytes(part)
            starts, stops, first = words.word_spans(data, offsets, words.ALNUM_OR_WIDE)
            hashes = words.word_hashes(data, starts, stops, words.FOLDED_VALUES)
            for text, (low, high) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                hit, items, longest = scan(tables, hashes[low:high])
                edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]))).tolist()
                spans = [
                    {
                        "first": a,
                        "last": b,
                        "start": int(starts[low + a] - offsets[text]),
                        "stop": int(stops[low + b - 1] - offsets[text]),
                    }
                    for a, b in zip(edges[::2], edges[1::2])
                ]
                rows.append((high - low, int(hit.sum()), longest, in_order(items), spans))
        return _found(rows)

    # A filter on what is found would be pushed below the scan with a scan of its own, in a worker of its own.
    return scan_texts.asNondeterministic()


def in_order(items: set[int | None]) -> list[int | None]:
    """Item ids in ascending order, null last."""
    return sorted(items, key=lambda item: (item is None, item or 0))


def _found(rows: list[tuple]) -> pa.Array:
    columns = list(zip(*rows)) if rows else [()] * len(KINDS)
    arrays = [pa.array(list(values), kind) for values, kind in zip(columns, KINDS.values())]
    return pa.StructArray.from_arrays(arrays, list(KINDS))


@F.arrow_udf(FOUND)
def merged(one: pa.Array, other: pa.Array) -> pa.Array:
    """What two automata found in one text; passages that touch or overlap become one."""
    rows = []
    for a, b in zip(one.to_pylist(), other.to_pylist()):
        spans: list[dict] = []
        for span in sorted(a["spans"] + b["spans"], key=lambda s: s["first"]):
            if spans and span["first"] <= spans[-1]["last"]:
                spans[-1] = {k: (min if k in ("first", "start") else max)(v, span[k]) for k, v in spans[-1].items()}
            else:
                spans.append(span)
        hit = sum(span["last"] - span["first"] for span in spans)
        items = in_order({*a["item_ids"], *b["item_ids"]})
        rows.append((a["n_words"], hit, max(a["longest"], b["longest"]), items, spans))
    return _found(rows)


@F.arrow_udf(T.StringType())
def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """Texts without the given byte ranges."""
    out = []
    for text, ranges in zip(texts.to_pylist(), spans.to_pylist()):
        if text and ranges:
            data, kept, at = text.encode(), [], 0
            for span in ranges:
                kept.append(data[at : span["start"]])
                at = span["stop"]
            text = b"".join([*kept, data[at:]]).decode()
        out.append(text)
    return pa.array(out, pa.string())


def decontaminate(
    docs: DataFrame, items: DataFrame, min_span: int = MIN_SPAN, max_coverage: float = MAX_COVERAGE
) -> DataFrame:
    """The documents, with the columns they have, freed from benchmark passages.

    A passage of at least ``min_span`` words is cut out (shorter items count by their windows, which are
    shorter, and stay unless ``min_span`` is lowered). A document goes if more than ``max_coverage`` of its
    words are hit. A document without a hit is returned as it is, null and empty texts included; rows that
    repeat are judged alike.
    """
    columns = docs.columns
    found = "found"
    while found in columns:
        found += "_"
    judged = overlaps(docs, items, found)
    judged = judged.where(F.col(f"{found}.n_hit") <= F.col(f"{found}.n_words") * F.lit(max_coverage))
    cut = F.filter(F.col(f"{found}.spans"), lambda s: s["last"] - s["first"] >= min_span)
    text = F.when(F.size(cut) > 0, without(F.col("text"), cut)).otherwise(F.col("text"))
    return judged.withColumn("text", text).select(*columns)


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)`` of every document.

    An item with a null id counts among the items and has no place in the joined ids.
    """
    found = overlaps(docs.select("doc_id", "text"), items).select("doc_id", "found.*")
    names = F.array_sort(F.transform("item_ids", lambda i: i.cast("string")))  # as strings, by code point
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
