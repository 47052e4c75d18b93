"""Near-duplicate documents by b-bit MinHash.

A document's words are hashed and its distinct five-word shingles minhashed. The full minima are used once, to
form band keys; what is kept of them is their low bits, packed into integers. Documents that share a band key
are candidates. Counting equal positions of two packed signatures estimates their similarity after correction
for positions that agree by chance; pairs far below the threshold are dropped by that estimate, all others are
confirmed on their full shingle sets, recomputed from the whole texts.

Documents with equal shingle sets are one item, so exact copies are never paired with each other.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import sketches, words
from broadsheet.llm.linking import Similarity, candidate_rows, components, link
from broadsheet.llm.sketches import pack
from broadsheet.llm.tables import Workspace

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5  # words
AT_LEAST = 75  # per cent

# A pair of similarity 0.75 shares no band with probability (1 - 0.75^5)^48 = 2e-6.
ROWS, BANDS = 5, 48
HASHES = ROWS * BANDS

# Pairs estimated below this are not confirmed. It lies five standard deviations below the threshold.
LINK_FLOOR = 0.58

_random = np.random.Generator(np.random.PCG64(words.SEED + 1))
FACTORS = _random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
BAND_SALT = words.mix(np.arange(1, BANDS + 1, dtype=np.uint64))

SIGNATURES = "n_shingles long, set_a long, set_b long, bands array<long>, low_bits array<long>"


SCRATCH = np.empty(1 << 18, dtype=np.uint32)


def minima(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function, a product modulo 2^32, over a set of 64-bit shingles."""
    small = (shingles >> np.uint64(32)).astype(np.uint32)
    step = len(SCRATCH) // len(factors)
    out = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    for low in range(0, len(small), step):
        part = small[low : low + step]
        values = SCRATCH[: len(factors) * len(part)].reshape(len(factors), len(part))
        np.multiply(factors[:, None], part, out=values)
        np.minimum(out, values.min(axis=1), out=out)
    return out


def band_keys(least: np.ndarray, rows: int, salt: np.ndarray) -> np.ndarray:
    """One key per band of ``rows`` minima."""
    parts = least.reshape(-1, rows).astype(np.uint64)
    return words.mix((parts * words.PLACE_VALUES[:rows]).sum(axis=1, dtype=np.uint64) + salt)


def estimate(a: Column, b: Column, hashes: int = HASHES) -> Column:
    """Similarity estimated from two packed signatures."""
    return sketches.estimate(a, b, hashes)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text."""
    for _, part in words.slices(column):
        data, offsets = words.text_bytes(part)
        starts, stops, first = words.word_spans(data, offsets, words.NOT_WHITE)
        hashes = words.word_hashes(data, starts, stops, words.FOLDED_VALUES)
        for low, high in zip(first[:-1], first[1:]):
            yield words.shingle_set(hashes[low:high], SHINGLE)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, set_a, set_b, bands, bits = [], [], [], [], []
        for shingles in _sets(batch.column("text")):
            counts.append(len(shingles))
            if not len(shingles):
                set_a.append(None), set_b.append(None), bands.append(None), bits.append(None)
                continue
            least = minima(shingles, FACTORS)
            set_a.append(shingles.sum(dtype=np.uint64).view(np.int64))
            set_b.append(words.mix(shingles + np.uint64(1)).sum(dtype=np.uint64).view(np.int64))
            bands.append(band_keys(least, ROWS, BAND_SALT).view(np.int64))
            bits.append(pack(least))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(counts, pa.int64()),
                pa.array(set_a, pa.int64()),
                pa.array(set_b, pa.int64()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(bits, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "low_bits"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, set_a, set_b, bands, low_bits)`` of every document, in one pass."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        _sign, f"doc_id long, {SIGNATURES}"
    )


def near_duplicates(docs: DataFrame, label: str = "minhash") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs`` ``(doc_id, text, ...)``.

    Null, empty and blank texts have no shingles and are linked with nothing. Rows with the same doc_id are
    one document: they share a component. A null doc_id takes part only as a copy: its component is that of
    the numbered documents with its set, else null, and then it is kept. Other columns are ignored.
    """
    work = Workspace(docs.sparkSession, label)
    signed = work.keep(signatures(docs))
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy("set_a", "set_b", "n_shingles")
    items = work.keep(
        classes.agg(
            F.min("doc_id").alias("item"), F.first("bands").alias("bands"), F.first("low_bits").alias("low_bits")
        )
    )
    members = items.select("set_a", "set_b", "n_shingles", "item")
    low_bits = items.select("item", F.col("low_bits").alias("sketch"))
    texts = docs.select(F.col("doc_id").cast("long").alias("item"), F.col("text").cast("string"))
    candidates = candidate_rows(items.select("item", F.col("bands").alias("keys")), BANDS, work)
    # The texts of items that share a key with others are written once.
    needed = candidates.select(F.explode(F.array("item", "leader")).alias("item")).distinct()
    needed = work.small(work.keep(needed.join(low_bits, "item")))
    # Repeated rows are one; a doc_id with several texts is linked by any of them.
    wanted = texts.join(needed, "item").groupBy("item", "sketch", F.xxhash64("text"))
    wanted = work.keep(wanted.agg(F.first("text").alias("text")).select("item", "text", "sketch"))
    similarity = Similarity(wanted, _sets, AT_LEAST, HASHES, LINK_FLOOR)
    links = link(candidates, similarity, work)
    # A document row belongs to the item of its set; rows of one doc_id with several sets join these sets.
    own = signed.join(members, ["set_a", "set_b", "n_shingles"], "left").select("doc_id", "n_shingles", "item")
    own = work.keep(own)
    several = own.where("doc_id <> item").select(F.col("doc_id").alias("a"), F.col("item").alias("b")).distinct()
    roots = components(links.union(several), work)
    labelled = own.join(roots, "item", "left")
    component = F.coalesce("root", "item", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, component.isNull())
    return labelled.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def representatives(docs: DataFrame, label: str = "minhash") -> DataFrame:
    """The documents, with the columns they have, that represent their component: the smallest doc_id.

    Documents without a word are linked with nothing and stay. So does a document with a null doc_id, unless
    it copies a numbered one. Rows that share the doc_id of a representative all stay.
    """
    found = near_duplicates(docs, label)
    # Every row of a doc_id is in one component; a null doc_id goes by its set.
    dropped = found.where("not kept and doc_id is not null").select(F.col("doc_id").alias("__dropped")).distinct()
    kept = docs.join(dropped, docs["doc_id"].cast("long") == F.col("__dropped"), "left_anti")
    return kept
