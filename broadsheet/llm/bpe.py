"""Byte-pair encoding and decoding with a public vocabulary whose words carry an end mark.

A text is cut at the marks of special tokens, composed (NFC), lower-cased code point by code point, and cut into
words by the pattern of the vocabulary file; white space is dropped. A word is a row of symbols, one per byte of
its UTF-8 form, the last with the end mark. Its merges come from a segment tree over adjacent pairs: a leaf holds
the rank of the pair that begins at its place, with the place in the low bits, so the root is the leftmost pair
of lowest rank. A merge changes three leaves, each in a logarithmic number of steps, until the root is empty.

Encoding stays on the row. The short words of a batch are merged together, a tree a word. Words met before are taken from a bounded table of the task; it saves time only.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm import tokenizers
from broadsheet.llm.tables import bound_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words kept in a task, some 100 bytes each, and the longest that is kept; both bound memory, not what is encoded.
KNOWN_WORDS, KNOWN_LENGTH = 300_000, 64

# Words of so many symbols are merged many at a time, in matrices of so many cells.
SHORT, ROWS_CELLS = 64, 1 << 17

EMPTY = (1 << 62) - 1  # a leaf without a mergeable pair
PLACE_BITS, PLACE_MASK = 31, (1 << 31) - 1
ID_BITS = 24


def byte_symbols() -> list[str]:
    """The character that stands for each byte in the vocabulary: printable Latin-1 for itself, others above 255."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shown = {byte: chr(byte) for byte in printable}
    others = (chr(0x100 + i) for i in range(256))
    return [shown.get(byte) or next(others) for byte in range(256)]


class Merges:
    """What two adjacent symbols become, and at which rank."""

    def __init__(self, pairs: list[tuple[int, int]], results: list[int]):
        self.results = np.array(results, dtype=np.int64)
        packed = np.array([left << ID_BITS | right for left, right in pairs], dtype=np.int64)
        self.rank_of = dict(zip(packed.tolist(), range(len(packed))))
        self.order = np.argsort(packed)
        self.sorted = packed[self.order]

    def leaves(self, left: np.ndarray, right: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The leaf of each pair."""
        packed = left << ID_BITS | right
        found = np.minimum(np.searchsorted(self.sorted, packed), len(self.sorted) - 1)
        return np.where(self.sorted[found] == packed, self.order[found] << PLACE_BITS | places, EMPTY)

    def leaf(self, left: int, right: int, place: int) -> int:
        rank = self.rank_of.get(left << ID_BITS | right)
        return EMPTY if rank is None else rank << PLACE_BITS | place


def merge_rows(symbols: np.ndarray, counts: np.ndarray, merges: Merges) -> None:
    """Merge many short words in place, one tree a row; ``symbols`` has a power of two of columns, at least two.

    A row holds ``counts`` symbols and is filled up with -1, which also takes the place of symbols merged away.
    """
    n_rows, n = symbols.shape
    places = np.arange(n)
    tree = np.full((n_rows, 2 * n), EMPTY, dtype=np.int64)
    pairs = merges.leaves(symbols[:, :-1], symbols[:, 1:], places[:-1])
    tree[:, n : 2 * n - 1] = np.where(symbols[:, 1:] >= 0, pairs, EMPTY)
    width = n >> 1
    while width:
        tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
        width >>= 1
    after, before = np.tile(places + 1, n_rows), np.tile(places - 1, n_rows)
    nodes, cells = tree.reshape(-1), symbols.reshape(-1)
    rows = np.flatnonzero(tree[:, 1] != EMPTY)
    while len(rows):
        root = nodes[rows * 2 * n + 1]
        row, at = rows * n, root & PLACE_MASK
        gone = after[row + at]
        follower = after[row + gone]
        cells[row + at] = joined = merges.results[root >> PLACE_BITS]
        cells[row + gone] = -1
        after[row + at] = follower
        on, leader = follower < counts[rows], before[row + at]
        before[row[on] + follower[on]] = at[on]
        new = np.full(len(rows), EMPTY)
        new[on] = merges.leaves(joined[on], cells[row[on] + follower[on]], at[on])
        led = leader >= 0
        ahead = merges.leaves(cells[row[led] + leader[led]], joined[led], leader[led])
        base = 2 * np.concatenate([row, row, row[led]])
        node = n + np.concatenate([gone, at, leader[led]])
        nodes[base + node] = np.concatenate([np.full(len(rows), EMPTY), new, ahead])
        # The three leaves lie at one depth, so they climb together.
        for _ in range(n.bit_length() - 1):
            node >>= 1
            child = base + 2 * node
            nodes[base + node] = np.minimum(nodes[child], nodes[child + 1])
        rows = rows[nodes[rows * 2 * n + 1] != EMPTY]


def merge_word(symbols: list[int], merges: Merges) -> list[int]:
    """The symbols of one word, however long, after all its merges."""
    n = len(symbols)
    size = 1 << n.bit_length()
    tree = array("q", [EMPTY]) * (2 * size)
    for i in range(n - 1):
        tree[size + i] = merges.leaf(symbols[i], symbols[i + 1], i)
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    after, before = array("q", range(1, n + 1)), array("q", range(-1, n - 1))
    symbols, results = array("q", symbols), merges.results.tolist()
    while (root := tree[1]) != EMPTY:
        at = root & PLACE_MASK
        gone, leader = after[at], before[at]
        follower = after[at] = after[gone]
        symbols[at], symbols[gone] = results[root >> PLACE_BITS], -1
        tree[size + gone] = tree[size + at] = EMPTY
        if follower < n:
            before[follower] = at
            tree[size + at] = merges.leaf(symbols[at], symbols[follower], at)
        if leader >= 0:
            tree[size + leader] = merges.leaf(symbols[leader], symbols[at], leader)
        for place in (gone, at, leader):
            node = (size + place) >> 1
            while place >= 0 and node and tree[node] != (least := min(tree[2 * node], tree[2 * node + 1])):
                tree[node] = least
                node >>= 1
    return [symbol for symbol in symbols if symbol >= 0]


class Known(dict):
    """Numbers of words. A word that is missing gets the next one; its ids are found with those of others."""

    def __init__(self, special: dict[str, int], spell: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]):
        super().__init__(zip(special, range(len(special))))
        self.spell, self.new, self.size = spell, [], len(special)
        self.ids, self.stops = [np.array([*special.values()], dtype=np.int64)], [np.arange(len(special) + 1)]

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        self.size += 1
        if len(word) <= KNOWN_LENGTH:
            self[word] = self.size - 1
        return self.size - 1

    def gather(self, words: array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the numbered words, and how many there are before each of them and in all."""
        if self.new:
            ids, lengths = self.spell(self.new)
            self.new = []
            self.ids.append(ids)
            self.stops.append(self.stops[-1][-1] + np.cumsum(lengths))
            self.ids, self.stops = [np.concatenate(self.ids)], [np.concatenate(self.stops)]
        flat, stops = self.ids[0], self.stops[0]
        at = np.array(words, dtype=np.int64)
        begins, lengths = stops[at], stops[at + 1] - stops[at]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        return flat[np.repeat(begins - totals[:-1], lengths) + np.arange(totals[-1])], totals


class Vocabulary:
    """A vocabulary file: words, merges, special tokens and the pattern of words."""

    def __init__(self, folder: str, name: str):
        with open(os.path.join(folder, name), encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in described["added_tokens"]}
        marks = sorted(self.special, key=len, reverse=True)
        self.mark = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")")
        self.word = regex.compile(described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.tokens: list[str | None] = [None] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, number in [*ids.items(), *self.special.items()]:
            self.tokens[number] = token
        shown = byte_symbols()
        # Symbols of a byte inside a word, and of one that ends it.
        self.symbols = np.array([[ids[symbol] for symbol in shown], [ids[symbol + end] for symbol in shown]])
        pairs = model["merges"]
        self.merges = Merges([(ids[a], ids[b]) for a, b in pairs], [ids[a + b] for a, b in pairs])
        self.end, self.described, self.library = end, described, None
        self.known = Known(self.special, self.spell)

    def words(self, text: str) -> list[str]:
        """The words of a stretch without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if any(unicodedata.category(character) == "Cn" for character in set(text)):
                return self._newer(text)
            # One code point at a time: a final sigma is a sigma.
            text = text.replace("\u03a3", "\u03c3")
        return self.word.findall(text.lower())

    def _newer(self, text: str) -> list[str]:
        """Words of a text with characters that the tables used here do not know, but the library's may."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(json.dumps(self.described))
        text = self.library.normalizer.normalize_str(text)
        split = self.library.pre_tokenizer.pre_tokenize_str(text)
        return [text[begin:stop] for _, (begin, stop) in split]

    def spell(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after another, and how many each has."""
        encoded = [word.encode() for word in words]
        lengths = np.array([len(word) for word in encoded])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        data = np.frombuffer(b"".join(encoded), dtype=np.uint8)
        last = np.zeros(len(data), dtype=np.int64)
        last[starts[1:] - 1] = 1
        flat = self.symbols[last, data]
        low = 1
        while low < SHORT:
            # Words of more than low and at most 2 * low symbols; longer ones have trees of their own.
            group = np.flatnonzero((lengths > low) & (lengths <= 2 * low))
            for first in range(0, len(group), ROWS_CELLS // low):
                some = group[first : first + ROWS_CELLS // low]
                at = starts[some][:, None] + np.arange(2 * low)
                inside = np.arange(2 * low) < lengths[some][:, None]
                rows = np.where(inside, flat[np.minimum(at, len(flat) - 1)], -1)
                merge_rows(rows, lengths[some], self.merges)
                flat[at[inside]] = rows[inside]
            low *= 2
        for i in np.flatnonzero(lengths > SHORT):
            begin, stop = starts[i], starts[i + 1]
            merged = merge_word(flat[begin:stop].tolist(), self.merges)
            flat[begin:stop] = np.pad(merged, (0, stop - begin - len(merged)), constant_values=-1)
        left = flat >= 0
        return flat[left], np.diff(np.concatenate([[0], np.cumsum(left)])[starts])

    def pieces(self, text: str) -> Iterator[str]:
        """The words and special tokens of a text."""
        for part in self.mark.split(text):
            yield from (part,) if part in self.special else self.words(part)

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of each text; null is an empty text."""
        parts, lengths = [], [np.zeros(1, dtype=np.int64)]
        words, stops = array("q"), [0]
        for number, text in enumerate(texts, start=1):
            words.extend(map(self.known.__getitem__, self.pieces(text.as_py() or "")))
            stops.append(len(words))
            if self.known.size > KNOWN_WORDS or number == len(texts):
                ids, totals = self.known.gather(words)
                parts.append(ids)
                lengths.append(np.diff(totals[stops]))
                words, stops = array("q"), [0]
                if self.known.size > KNOWN_WORDS:
                    self.known = Known(self.special, self.spell)
        values = np.concatenate([np.zeros(0, dtype=np.int64), *parts])
        offsets = np.cumsum(np.concatenate(lengths))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(np.int32)))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The tokens of each row, joined by blanks."""
        return pc.binary_join(_named(ids, pa.array(self.tokens, pa.string())), " ")

    def restore(self, ids: pa.Array) -> pa.Array:
        """The words of each row, joined by blanks; bytes that are no UTF-8 become replacement characters."""
        value = {symbol: bytes([byte]) for byte, symbol in enumerate(byte_symbols())}

        def spelled(token: str | None) -> bytes | None:
            if token is None or token in self.special:
                return token and token.encode() + b" "
            ended = token.endswith(self.end)
            return b"".join(value[c] for c in token.removesuffix(self.end)) + b" " * ended

        table = pa.array(list(map(spelled, self.tokens)), pa.binary())
        joined = pc.binary_join(_named(ids, table), b"")
        return pa.array([row.as_py().decode("utf-8", "replace").removesuffix(" ") for row in joined], pa.string())


def _named(ids: pa.Array, names: pa.Array) -> pa.ListArray:
    """For each row of ids their names; null and ids without a name are left out, and null rows are empty."""
    lengths = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    flat = pc.fill_null(ids.flatten().cast(pa.int64()), -1).to_numpy(zero_copy_only=False)
    known = (flat >= 0) & (flat < len(names))
    known[known] = pc.is_valid(names).to_numpy(zero_copy_only=False)[flat[known]]
    counts = np.bincount(np.repeat(np.arange(len(lengths)), lengths)[known], minlength=len(lengths))
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), names.take(pa.array(flat[known])))


class _Loaded:
    """A vocabulary, read by the first batch of a task."""

    def __init__(self, folder: str, name: str):
        self.file, self.vocabulary = (folder, name), None

    def __call__(self) -> Vocabulary:
        if self.vocabulary is None:
            self.vocabulary = Vocabulary(*self.file)
        return self.vocabulary


def _applied(kind: str, method: str, folder: str, name: str) -> Callable:
    loaded = _Loaded(folder, name)

    @F.arrow_udf(kind)
    def apply(column: pa.Array) -> pa.Array:
        return getattr(loaded(), method)(column)

    return apply


def encode(text: Column, folder: str = tokenizers.FOLDER, name: str = tokenizers.WORD_BPE) -> Column:
    """Ids of the whole text as ``array<int>``; empty for null, empty and blank texts."""
    return _applied("array<int>", "encode", folder, name)(text.cast("string"))


def decode(ids: Column, folder: str = tokenizers.FOLDER, name: str = tokenizers.WORD_BPE) -> Column:
    """Tokens of the ids, joined by blanks; null and ids without a token are left out, a null array is empty."""
    return _applied("string", "decode", folder, name)(ids.cast("array<int>"))


def restore(ids: Column, folder: str = tokenizers.FOLDER, name: str = tokenizers.WORD_BPE) -> Column:
    """Words of the ids, joined by blanks: the encoded text in lower case, its white space reduced to word ends."""
    return _applied("string", "restore", folder, name)(ids.cast("array<int>"))


def coded(docs: DataFrame, folder: str = tokenizers.FOLDER, name: str = tokenizers.WORD_BPE) -> DataFrame:
    """``(doc_id, ids, decoded)`` of ``docs`` ``(doc_id, text, ...)``: :func:`encode` and :func:`decode` in one go.

    As columns, the second would have its text encoded once more.
    """
    loaded = _Loaded(folder, name)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = loaded().encode(batch.column("text"))
            columns = [batch.column("doc_id"), ids, loaded().decode(ids)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    bound_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.col("text").cast("string"))
    return texts.mapInArrow(both, f"doc_id {kind}, ids array<int>, decoded string")


def digest(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` for every row of ``docs`` ``(doc_id, text, ...)``.

    Digests are lowercase hex: of the decimal ids joined by blanks, and of the decoded text. Null and empty texts
    have no tokens and the digests of the empty string. Rows are independent of each other, so repeated rows and
    null ids give rows of their own; other columns are ignored. Nothing is shuffled.
    """
    return coded(docs).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
