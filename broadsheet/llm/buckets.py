"""Band keys that several items share.

Nearly all of the keys belong to one item, so they are not moved one to a row: a task packs the keys it reads
into one row per shard, and a shard is reduced by sorted merges of numpy arrays. A key moves with its item, 16 bytes;
one that a task has met with several items moves once, with the smallest and the largest, so a key of very many
items moves a few numbers per task.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.tables import BROADCAST_ROWS

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keys sorted at a time, which bounds the memory of a task; a shard has about as many different ones.
CHUNK = 1 << 18

# Bits of a key that are looked up before the key itself is.
FIRST_BITS = 22

SHARED = "key long, leader long, last long, n long"
PACKED = "shard int, entries binary"

# A key with its smallest and largest item and the number of items counted for it.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def combine(parts: list[Entries]) -> Entries:
    """One entry per key, sorted by key."""
    key, least, most, n = (np.concatenate(column) for column in zip(*parts))
    order = np.argsort(key)
    key = key[order]
    begins = np.flatnonzero(np.diff(key, prepend=key[:1] - 1)) if len(key) else np.zeros(0, dtype=np.int64)
    if not len(begins):
        return key, least, most, n
    return (
        key[begins],
        np.minimum.reduceat(least[order], begins),
        np.maximum.reduceat(most[order], begins),
        np.add.reduceat(n[order], begins),
    )


def keyed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Items and keys, one of each per key.

    A row has an ``item`` and an array of its ``keys``, or several ``items`` and, as bytes, the keys of one after another.
    """
    if "item" in batch.schema.names:
        keys = batch.column("keys")
        counts = np.diff(keys.offsets.to_numpy())
        return np.repeat(batch.column("item").to_numpy(), counts), keys.flatten().to_numpy()
    items = batch.column("items").flatten().to_numpy()
    column = batch.column("keys")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]] if len(column) else b""
    keys = np.frombuffer(bytes(data), dtype=np.int64)
    return np.repeat(items, len(keys) // max(len(items), 1)), keys


def _single(items: np.ndarray, keys: np.ndarray) -> Entries:
    return keys, items, items, np.ones(len(keys), dtype=np.int64)


def _packed(entries: Entries) -> bytes:
    """The number of entries with one item, these as key and item, and the others whole."""
    key, least, most, n = entries
    alone = n == 1
    several = [column[~alone] for column in entries]
    return np.concatenate([[alone.sum()], key[alone], least[alone], *several]).astype(np.int64).tobytes()


def _unpacked(data: memoryview) -> list[Entries]:
    # Copied, as the batch is not to be held for its sake.
    numbers = np.frombuffer(data, dtype=np.int64).copy()
    stop = 1 + 2 * int(numbers[0])
    keys, items = numbers[1:stop].reshape(2, -1)
    return [_single(items, keys), tuple(numbers[stop:].reshape(4, -1))]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """The range that each key is in, of so many equal ones; rising with the key."""
    high = (keys >> 32) + (1 << 31)
    return ((high * shards) >> 32).astype(np.int32)


def _pack(shards: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            parts.append(_single(*keyed(batch)))
            size += len(parts[-1][0])
            if size >= CHUNK:
                yield _rows(combine(parts))
                parts, size = [], 0
        if size:
            yield _rows(combine(parts))

    def _rows(entries: Entries) -> pa.RecordBatch:
        # Shards are ranges of keys, so that sorted entries are cut, not sorted again.
        shard = shard_of(entries[0], shards)
        begins = np.flatnonzero(np.diff(shard, prepend=-1))
        cut = zip(*(np.split(column, begins[1:]) for column in entries))
        packed = pa.array([_packed(part) for part in cut], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(shard[begins]), packed], names=["shard", "entries"])

    return pack


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    state, parts, size = None, [], 0
    for batch in batches:
        for entries in batch.column("entries"):
            parts += _unpacked(entries.as_buffer())
            size += len(parts[-1][0]) + len(parts[-2][0])
            if size >= max(CHUNK, len(state[0]) if state else 0):
                state = combine(parts + ([state] if state else []))
                parts, size = [], 0
    if not parts and not state:
        return
    key, least, most, n = combine(parts + ([state] if state else []))
    shared = least < most
    table = pa.Table.from_arrays(
        [pa.array(column[shared]) for column in (key, least, most, n)], names=["key", "leader", "last", "n"]
    )
    yield from table.to_batches(max_chunksize=1 << 16)


class Among:
    """Which keys are among some sorted ones: their first bits tell nearly all that are not."""

    def __init__(self, known: np.ndarray):
        self.known = known
        self.bits = np.zeros(1 << FIRST_BITS, dtype=bool)
        self.bits[self._first(known)] = True

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        among = self.bits[self._first(keys)]
        likely = np.flatnonzero(among)
        at = np.searchsorted(self.known, keys[likely])
        at[at == len(self.known)] = 0
        among[likely] = self.known[at] == keys[likely]
        return among

    @staticmethod
    def _first(keys: np.ndarray) -> np.ndarray:
        return keys.view(np.uint64) >> np.uint64(64 - FIRST_BITS)


def keys_of(listed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(key, item)``, a row for each key of ``listed`` that is among those of ``wanted`` ``(key, ...)``, a written table.

    Few wanted keys, counted, are sent to the tasks; more are joined.
    """
    few = wanted.count() <= BROADCAST_ROWS
    chosen = np.sort(wanted.select("key").toArrow()["key"].to_numpy()) if few else None
    shared = listed.sparkSession.sparkContext.broadcast(chosen)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        among = None if shared.value is None else Among(shared.value)
        for batch in batches:
            items, keys = keyed(batch)
            if among is not None:
                chosen = among(keys)
                items, keys = items[chosen], keys[chosen]
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(items)], names=["key", "item"])

    found = listed.mapInArrow(expand, "key long, item long")
    return found if few else found.join(wanted.select("key"), "key", "left_semi")


def shared_keys(listed: DataFrame, keys_each: int) -> DataFrame:
    """``(key, leader, last, n)`` of the keys that several items share in ``listed``, a written table with the columns
    of :func:`keyed` and ``keys_each`` keys an item: the smallest and the largest item, and ``n``, which is two only
    if there are no others, and may count an item again that is listed in several tasks.
    """
    n_items = listed.count() if "item" in listed.columns else listed.agg(F.sum(F.size("items"))).first()[0] or 0
    shards = n_items * keys_each // CHUNK + 1
    packed = listed.mapInArrow(_pack(shards), PACKED)
    return packed.repartition(shards, "shard").select("entries").mapInArrow(_merge, SHARED)
