"""Fuzzy line deduplication by MinHash.

A text is cut at line feeds. Lines are compared without regard to case and white space: their character
shingles are minhashed, lines that agree in a band are candidates, candidates are confirmed by the exact
Jaccard similarity of their shingle sets, and of every connected component one line stays, the first by
(doc_id, place). Equal lines are one item from the start, so copies are never paired.

Two rules say which lines take part. By default lines of fewer than ``MIN_WORDS`` words stay. With ``every`` all
lines but blank ones take part: those that have more than one shingle are compared like all others, whatever their
words, and shorter ones are compared for equality.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import words
from broadsheet.llm.linking import Similarity, candidate_rows, components, link
from broadsheet.llm.sketches import LOW_BITS, pack_rows, plane_size
from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 8  # characters (bytes of UTF-8); a line that is compared has at least nine
AT_LEAST = 80  # per cent
MIN_WORDS = 5

# A pair of similarity 0.8 shares no band with probability (1 - 0.8^4)^12 = 2e-3, one of 0.85 with 1e-4, one of 0.9
# with 2e-6.
ROWS, BANDS = 4, 12
HASHES = ROWS * BANDS
SKETCH = plane_size(HASHES) * LOW_BITS  # integers

# Four standard deviations of the estimate below the threshold.
LINK_FLOOR = 0.53

_random = np.random.Generator(np.random.PCG64(words.SEED + 2))
FACTORS = _random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
BAND_SALT = words.mix(np.arange(1, BANDS + 1, dtype=np.uint64) << np.uint64(8))

LINE_FEED = "\n"


class Lines:
    """The lines of some texts that are compared, in comparable form: lower case, single blanks, trimmed.

    ``data`` holds them one after another with other bytes between; line ``i`` is ``data[start[i]:stop[i]]``, the
    line ``place[i]`` of text ``text[i]``. Lines that are not ``fuzzy`` are compared for equality only.
    """

    def __init__(self, column: pa.Array, every: bool = False):
        raw, offsets = words.text_bytes(column)
        starts, stops, first = words.word_spans(raw, offsets, words.NOT_WHITE)
        feeds = np.flatnonzero(raw == 0x0A)
        # Words are many: their texts and lines are counted on, not looked up.
        text_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        feeds_before = np.repeat(np.arange(len(feeds) + 1), np.diff(np.searchsorted(starts, feeds), prepend=0, append=len(starts)))
        # A line is told apart by its text and the line feeds before it.
        heads = np.flatnonzero(np.diff(feeds_before, prepend=-1) | np.diff(text_of, prepend=-1))
        tails = np.append(heads[1:], len(starts))[: len(heads)]  # none, if there is no word
        data = words.FOLD[raw]
        keep = words.NOT_WHITE[raw]
        inner = np.ones(len(starts), dtype=bool)
        inner[heads] = False
        blanks = starts[inner] - 1  # before each word but the first of its line
        data[blanks] = 0x20
        keep[blanks] = True
        new = np.cumsum(keep)
        if not every:
            full = tails - heads >= MIN_WORDS
            heads, tails = heads[full], tails[full]
        self.data = data[keep]
        self.start, self.stop = new[starts[heads]] - 1, new[stops[tails - 1] - 1]
        self.fuzzy = self.stop - self.start > SHINGLE
        self.text = text_of[heads]
        self.place = feeds_before[heads] - np.searchsorted(feeds, offsets[self.text])
        self.rolling = words.Rolling(self.data, words.BYTE_VALUES)
        self.ids = self.rolling.stretches(self.start, self.stop)

    def taken(self, chosen: np.ndarray) -> pa.Array:
        """The comparable forms of some lines."""
        starts, lengths = self.start[chosen], self.stop[chosen] - self.start[chosen]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        data = self.data[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
        buffers = [pa.py_buffer(values.tobytes()) for values in (offsets.astype(np.int32), data)]
        return pa.StringArray.from_buffers(len(chosen), *buffers)


def _line_slices(column: pa.Array, every: bool) -> Iterator[tuple[pa.Array, Lines]]:
    for _, part in words.slices(column, words.SPAN // 2):
        yield part, Lines(part, every)


def _listed(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _minima(lines: Lines, chosen: np.ndarray) -> np.ndarray:
    """The minima of some lines, one or more, a row each."""
    shingles = lines.rolling.windows(SHINGLE)
    small = np.empty(len(shingles) + 1, dtype=np.uint32)
    small[:-1], small[-1] = shingles >> np.uint64(32), 0xFFFFFFFF
    # Every second stretch is what stands between two lines.
    edges = np.stack([lines.start[chosen], lines.stop[chosen] - SHINGLE + 1], axis=1).reshape(-1)
    least = np.empty((HASHES, len(edges)), dtype=np.uint32)
    for row, factor in zip(least, FACTORS):
        np.minimum.reduceat(small * factor, edges, out=row)
    return np.ascontiguousarray(least[:, ::2].T)


def _band_keys(least: np.ndarray) -> np.ndarray:
    """The band keys of rows of minima."""
    parts = least.reshape(len(least), BANDS, ROWS) * words.PLACE_VALUES[:ROWS]
    return words.mix(parts.sum(axis=2, dtype=np.uint64) + BAND_SALT)


def _in_bytes(keys: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Rows of keys as bytes, so many rows for each document."""
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * (8 * BANDS)
    return pa.BinaryArray.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(keys.tobytes())])


def _signer(every: bool) -> Callable:
    """Places and ids of the lines of each document; beside the first line of its kind in a slice, its band keys,
    sketch and comparable form."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for part, lines in _line_slices(batch.column("text"), every):
                _, first = np.unique(lines.ids, return_index=True)
                first = np.sort(first[lines.fuzzy[first]])
                counts = np.bincount(lines.text, minlength=len(part))
                fresh = np.bincount(lines.text[first], minlength=len(part))
                least = _minima(lines, first) if len(first) else np.zeros((0, HASHES), dtype=np.uint32)
                places = pa.StructArray.from_arrays(
                    [pa.array(lines.place, pa.int32()), pa.array(lines.ids.view(np.int64))], ["place", "item"]
                )
                items, texts = pa.array(lines.ids[first].view(np.int64)), lines.taken(first)
                sketches = pa.array(pack_rows(least).reshape(-1))
                sketches = _listed(np.full(len(first), SKETCH), sketches)
                # The keys of a document's lines go as bytes: only the packing task looks at each.
                keys = _in_bytes(_band_keys(least), fresh)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(row, len(part)),
                        batch.column("text_id").slice(row, len(part)),
                        _listed(counts, places),
                        _listed(fresh, items),
                        keys,
                        _listed(fresh, sketches),
                        _listed(fresh, texts),
                    ],
                    names=["doc_id", "text_id", "lines", "items", "keys", "sketches", "texts"],
                )
                row += len(part)

    return sign


SIGNED = (
    "doc_id long, text_id long, lines array<struct<place:int,item:long>>, items array<long>,"
    " keys binary, sketches array<array<long>>, texts array<string>"
)


def _line_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of comparable lines."""
    for _, part in words.slices(column, words.SPAN):
        data, offsets = words.text_bytes(part)
        shingles = words.Rolling(data, words.BYTE_VALUES).windows(SHINGLE)
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            found = np.sort(shingles[low : high - SHINGLE + 1])
            yield found[np.concatenate([[True], found[1:] != found[:-1]])]


def _of_lines(signed: DataFrame, *columns: str) -> DataFrame:
    """``(item, ...)``, a row per signed line, with some of what is listed of it."""
    listed = signed.select(F.explode(F.arrays_zip(F.col("items").alias("item"), *columns)).alias("line"))
    return listed.select("line.*")


def repeated_lines(docs: DataFrame, work: Workspace, every: bool = False) -> DataFrame:
    """``(doc_id, text_id, places)``: the lines to remove from the documents that have any.

    Rows that agree in doc_id and text are one document.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    signed = docs.select("doc_id", _text_id(), "text").mapInArrow(_signer(every), SIGNED)
    signed = work.keep(signed.where(F.size("lines") > 0), False)
    lines = signed.select("doc_id", "text_id", "lines")
    candidates = candidate_rows(signed.select("items", "keys"), BANDS, work)
    # The lines that share a key with others: few, counted, are sent to the tasks, more are joined.
    needed = candidates.select(F.explode(F.array("item", "leader")).alias("item")).distinct()
    texts = _of_lines(signed, "sketches", "texts").join(work.small(work.keep(needed)), "item", "left_semi")
    texts = texts.groupBy("item").agg(F.min("texts").alias("text"), F.first("sketches").alias("sketch"))
    similarity = Similarity(work.keep(texts), _line_sets, AT_LEAST, HASHES, LINK_FLOOR)
    links = link(candidates, similarity, work)
    roots = components(links, work)
    line = lines.select("doc_id", "text_id", F.explode("lines").alias("line")).select("doc_id", "text_id", "line.*")
    # Lines that stand alone stay. Only the others are ordered: the first of every component stays, too.
    several = line.groupBy("item").agg(F.count("*").alias("n")).join(roots, "item", "left")
    several = work.keep(several.where("n > 1 or root is not null").select("item", F.coalesce("root", "item").alias("root")))
    place = F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), "text_id", "place")
    repeated = work.keep(line.join(work.small(several), "item").select("root", "doc_id", "text_id", "place"))
    repeated = repeated.withColumn("own", place)
    best = work.keep(repeated.groupBy("root").agg(F.min("own").alias("best")))
    dropped = repeated.join(work.small(best), "root").where("own > best")
    return dropped.groupBy("doc_id", "text_id").agg(F.collect_set("place").alias("places"))


def _text_id() -> Column:
    return F.xxhash64("text").alias("text_id")


def dedup_lines(docs: DataFrame, label: str = "line-dedup", every: bool = False) -> DataFrame:
    """All columns of ``docs``, the text without its repeated lines, and ``n_lines`` and ``n_dropped``.

    ``every`` lets lines of few words take part, too. Null and empty texts have no line to lose. A null doc_id orders after all others. Rows that agree in
    doc_id and text are one document and get the same result. Columns of other names pass through; the two
    counts take a ``_`` more where their names are in use.
    """
    work = Workspace(docs.sparkSession, label)
    places = repeated_lines(docs, work, every).select(
        F.col("doc_id").alias("__id"), F.col("text_id").alias("__text"), F.col("places").alias("__places")
    )
    text = F.col("text").cast("string")
    joined = docs.join(
        work.small(work.keep(places)),
        docs["doc_id"].cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__text")),
        "left",
    )
    lines = F.split(text, LINE_FEED, -1)
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("__places", i)), LINE_FEED)
    names = ["n_lines", "n_dropped"]
    while set(names) & set(docs.columns):
        names = [f"{name}_" for name in names]
    feeds = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(LINE_FEED), F.lit("")))
    counts = [F.coalesce(feeds + 1, F.lit(0)), F.coalesce(F.size("__places"), F.lit(0))]
    return joined.select(
        *[c for c in docs.columns if c != "text"],
        F.when(F.col("__places").isNull(), text).otherwise(kept).alias("text"),
        *[count.cast("long").alias(name) for count, name in zip(counts, names)],
    )
