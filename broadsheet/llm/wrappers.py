"""Main text of pages by wrappers inferred per host: union-free regular expressions.

The block tokens of a page make a regular expression without alternatives: elements, text slots, and groups that
repeat. Two expressions of one host are aligned token by token: what only one of them has becomes optional,
neighbours of the same form become a repeated group, and a slot whose texts differ holds data. A slot that has the
same text on all its pages is template. Aligned one after another, all pages of a host give its wrapper, with the
amount of text that each part holds over all pages.

Alignment is associative enough to be done in parts: every task aligns the pages it reads, and the few partial
wrappers of a host are aligned with each other, some at a time. The wrapper then names the parts that hold the main
text and the template slots inside them, and every page is read with the wrapper of its host.

Pages are of any width and depth. An element with very many different parts has them told apart by element name in
the wrapper, ``div.*`` for any division; pages are read with their full keys, which such a part matches.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from hashlib import md5

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.llm.markup import MAIN_TAGS, Element, parse
from broadsheet.llm.tables import Workspace
from broadsheet.llm.url_filters import host

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements that are descended into where they hold all text of their parent.
DESCEND = frozenset("html body div section main article td table tbody tr center".split())

# Beyond so many different parts in one element, parts are told apart by element name only.
MOST_PARTS = 200

# Pages that a slot has to stand on, with one text, to be template; and how much of the main text template may be.
TEMPLATE_PAGES = 10
TEMPLATE_SHARE = 1 / 3

# Groups in which the partial wrappers of a host are aligned first.
GROUPS = 16

# Elements nest in each other as deep as a page has it; a frame of a Python function takes little.
DEEPEST = 1_000_000

# Partial wrappers of so many hosts are held by a task at a time.
HELD_HOSTS = 2000


class Part:
    """A part of a wrapper: a text slot (``#``) or an element with parts, optional or repeated.

    ``chars`` is what it holds over all pages, ``pages`` how many have it, and ``same`` the digest of the text of a
    slot as long as there is one only.
    """

    __slots__ = ("key", "optional", "repeated", "chars", "pages", "same", "parts")

    def __init__(self, key: str, optional: bool, repeated: bool, chars: int, pages: int, same: str | None, parts: list[Part]):
        self.key, self.optional, self.repeated, self.chars = key, optional, repeated, chars
        self.pages, self.same, self.parts = pages, same, parts

    def to_rows(self) -> list[list]:
        """The part and those below it, each before its own, with their depth."""
        rows, todo = [], [(self, 0)]
        while todo:
            part, depth = todo.pop()
            rows.append([depth, part.key, part.optional, part.repeated, part.chars, part.pages, part.same])
            todo.extend((inner, depth + 1) for inner in reversed(part.parts))
        return rows

    @staticmethod
    def of_rows(rows: list[list]) -> Part:
        path: list[Part] = []
        for depth, *values in rows:
            part = Part(*values, [])
            del path[depth:]
            if path:
                path[-1].parts.append(part)
            path.append(part)
        return path[0]


def digest(text: str) -> str:
    return md5(text.encode(), usedforsecurity=False).hexdigest()


def of_page(element: Element) -> Part:
    """The wrapper of a single page: its elements, with repeated neighbours as one repeated part."""
    if element.key == "#":
        return Part("#", False, False, len(element.text) - element.linked, 1, digest(element.text), [])
    parts = [of_page(child) for child in element.children if not child.aside]
    return Part(element.key, False, False, sum([p.chars for p in parts]), 1, None, folded(parts))


def folded(parts: list[Part]) -> list[Part]:
    """Neighbours of the same form, single parts or groups of two, as one repeated part each."""
    out: list[Part] = []
    for part in parts:
        if out and out[-1].key == part.key:
            out[-1] = _repeat(out[-1], part)
        elif len(out) >= 3 and out[-2].key == part.key and out[-3].key == out[-1].key:
            # x y x + y: the pair (x y) repeats.
            last = out.pop()
            out[-2] = _repeat(out[-2], last)
            out[-1] = _repeat(out[-1], part)
        else:
            out.append(part)
    return _bounded(out)


def _repeat(a: Part, b: Part) -> Part:
    merged = aligned(a, b)
    # What stands several times on a page is no slot of the template.
    merged.repeated, merged.optional, merged.same = True, a.optional, None
    merged.pages = max(a.pages, b.pages)
    return merged


def _bounded(parts: list[Part]) -> list[Part]:
    """Parts told apart by element name where there are very many, and all of unusual names as one."""
    if len(parts) <= MOST_PARTS:
        return parts
    by_tag: dict[str, Part] = {}
    for part in parts:
        tag = part.key.split(".", 1)[0]
        part.key = f"{tag}.*" if tag in DESCEND else "*" if tag != "#" else tag
        by_tag[part.key] = _repeat(by_tag[part.key], part) if part.key in by_tag else part
    for part in by_tag.values():
        part.optional = True
    return list(by_tag.values())


def matches(key: str, element: Element) -> bool:
    """Whether an element of a page is of the key of a wrapper's part."""
    return element.key == key or key == f"{element.tag}.*"


def aligned(a: Part, b: Part) -> Part:
    """One part that matches whatever the two match."""
    pairs = _alignment([p.key for p in a.parts], [p.key for p in b.parts])
    out, i, j = [], 0, 0
    for x, y in [*pairs, (len(a.parts), len(b.parts))]:
        # What lies between two matches is in one of the expressions only: optional.
        for part in [*a.parts[i:x], *b.parts[j:y]]:
            part.optional = True
            out.append(part)
        if x < len(a.parts):
            out.append(aligned(a.parts[x], b.parts[y]))
        i, j = x + 1, y + 1
    parts: list[Part] = []
    for part in out:
        if parts and parts[-1].key == part.key:
            parts[-1] = _repeat(parts[-1], part)
        else:
            parts.append(part)
    same = a.same if a.same == b.same else None
    optional, repeated = a.optional or b.optional, a.repeated or b.repeated
    return Part(a.key, optional, repeated, a.chars + b.chars, a.pages + b.pages, same, _bounded(parts))


def _alignment(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of a longest common subsequence; both sequences are bounded."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def expression(part: Part) -> str:
    """The wrapper as a regular expression over block tokens."""
    out: list[str] = []
    todo: list[Part | str] = [part]
    while todo:
        node = todo.pop()
        if isinstance(node, str):
            out.append(node)
            continue
        sign = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[node.optional, node.repeated]
        if sign:
            out.append("(")
            todo.append(f"){sign}")
        if node.key == "#":
            out.append("#text")
        else:
            out.append(f"<{node.key}>")
            todo.append(f"</{node.key.split('.')[0]}>")
            todo.extend(reversed(node.parts))
    return " ".join(out)


def main_paths(root: Part) -> list[list[str]]:
    """Keys from below the root to the parts with the main text.

    These are the elements for main content; without any, the innermost part that holds all text. Links are no text.
    """
    paths = _to_main_tags(root)
    if paths:
        return paths
    path, node = [], root
    while True:
        inner = [p for p in node.parts if p.key.split(".", 1)[0] in DESCEND and not p.repeated]
        best = max(inner, key=lambda p: p.chars, default=None)
        # Text beside a part belongs to the main text: the part alone would lose it.
        if best is None or not best.chars or best.chars < node.chars:
            return [path]
        path, node = [*path, best.key], best


def _to_main_tags(root: Part) -> list[list[str]]:
    """Paths to the outermost elements for main content that have text: the one with the most, and those beside it
    that do not repeat. Repeated ones beside it are lists of other articles."""
    found: list[tuple[Part, list[str]]] = []
    todo: list[tuple[Part, list[str]]] = [(root, [])]
    while todo:
        node, path = todo.pop()
        for part in node.parts:
            here = [*path, part.key]
            if part.key.split(".", 1)[0] in MAIN_TAGS:
                if part.chars:
                    found.append((part, here))
            elif part.chars and part.parts:
                todo.append((part, here))
    best = max((part.chars for part, _ in found), default=0)
    return [path for part, path in found if part.chars == best or not part.repeated]


def template_slots(root: Part, paths: list[list[str]]) -> list[list[str]]:
    """Keys from below the root to each slot that is template inside the main text, and last the digest of its text.

    There are none where they would be much of the main text: then the pages are copies, not of one template.
    """
    found: list[tuple[list[str], int]] = []
    total = 0
    for main in paths:
        node = root
        for key in main:
            node = next(part for part in node.parts if part.key == key)
        total += node.chars
        todo = [(node, main)]
        while todo:
            node, path = todo.pop()
            for part in node.parts:
                if part.key != "#":
                    todo += [] if part.repeated else [(part, [*path, part.key])]
                elif part.same and part.pages >= TEMPLATE_PAGES:
                    found.append(([*path, part.same], part.chars))
    return [slot for slot, _ in found] if sum(chars for _, chars in found) <= total * TEMPLATE_SHARE else []


def read(element: Element, path: list[str]) -> str:
    """The text of a page at a path, its blocks joined by line feeds; empty if it has no such part."""
    return read_all(element, [path])


def read_all(element: Element, paths: list[list[str]], template: list[list[str]] = (), named: bool = True) -> str:
    """The text of a page at some paths, in page order, its blocks joined by line feeds.

    Slots with a text of the ``template`` are left out; ``named`` tells whether elements may be asides by name.
    """
    dropped = set()
    for *path, same in template:
        for node in _at(element, path):
            dropped.update(id(c) for c in node.children if c.key == "#" and digest(c.text) == same)
    chosen = {id(node) for path in paths for node in _at(element, path)}
    out: list[str] = []
    todo = [(element, False)]
    while todo:
        node, inside = todo.pop()
        inside = inside or id(node) in chosen
        if node.key == "#":
            if inside and id(node) not in dropped:
                out.append(node.text)
        elif not node.aside or node is element or not named and node.aside == "words":
            todo.extend((child, inside) for child in reversed(node.children))
    return "\n".join(out)


def _at(element: Element, path: list[str]) -> list[Element]:
    """The elements of a page at a path."""
    nodes = [element]
    for key in path:
        nodes = [c for node in nodes for c in node.children if not c.aside and matches(key, c)]
    return nodes


def _partial_wrappers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sys.setrecursionlimit(DEEPEST)
    held: dict[str, Part] = {}

    def emit() -> pa.RecordBatch:
        rows = [json.dumps(part.to_rows()) for part in held.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(rows, pa.string())], names=["host", "wrapper"])

    for batch in batches:
        for name, html in zip(batch.column("host"), batch.column("html")):
            name = name.as_py()
            wrapper = of_page(parse(html.as_py()))
            held[name] = aligned(held[name], wrapper) if name in held else wrapper
        if len(held) > HELD_HOSTS:
            yield emit()
            held.clear()
    if held:
        yield emit()


def _all_aligned(texts: pd.Series) -> Part:
    sys.setrecursionlimit(DEEPEST)
    merged = None
    for text in sorted(texts):
        part = Part.of_rows(json.loads(text))
        merged = part if merged is None else aligned(merged, part)
    return merged


def _merge_some(rows: pd.DataFrame) -> pd.DataFrame:
    """One of some partial wrappers of a host."""
    merged = _all_aligned(rows["wrapper"])
    return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [json.dumps(merged.to_rows())]})


def _merge(rows: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of a host, and where it has the main text and template inside it."""
    merged = _all_aligned(rows["wrapper"])
    paths = main_paths(merged)
    found = {"wrapper": expression(merged), "paths": paths, "template": template_slots(merged, paths)}
    return pd.DataFrame({"host": [rows["host"].iloc[0]], **{name: [value] for name, value in found.items()}})


def wrappers(pages: DataFrame) -> DataFrame:
    """``(host, wrapper, paths, template)`` of all hosts, from all their ``pages`` ``(host, html)``."""
    partial = pages.select("host", "html").mapInArrow(_partial_wrappers, "host string, wrapper string")
    group = F.pmod(F.xxhash64("wrapper"), F.lit(GROUPS))
    some = partial.groupBy("host", group).applyInPandas(_merge_some, "host string, wrapper string")
    places = "paths array<array<string>>, template array<array<string>>"
    return some.groupBy("host").applyInPandas(_merge, f"host string, wrapper string, {places}")


@F.arrow_udf(T.StringType())
def main_text(htmls: pa.Array, paths: pa.Array, templates: pa.Array) -> pa.Array:
    """Main text of each page, by the wrapper of its host, else by its own, else with asides by name."""
    sys.setrecursionlimit(DEEPEST)
    out = []
    for html, path, template in zip(htmls, paths, templates):
        page = parse(html.as_py())
        text = read_all(page, path.as_py() or [], template.as_py() or [])
        if not text:
            text = read_all(page, main_paths(of_page(page))) or read_all(page, [[]], named=False)
        out.append(text)
    return pa.array(out, pa.string())


def extract(pages: DataFrame, label: str = "wrappers") -> DataFrame:
    """All columns of ``pages`` ``(url, html, ...)`` but ``html``, with ``text`` and ``n_chars``.

    Null and empty pages, and pages without main text, have an empty text. Pages without a host are aligned
    with each other. Repeated rows are read alike. Pages may have any number of elements, at any depth. Other columns pass through; added ones take a ``_`` more
    where their names are in use.
    """
    work = Workspace(pages.sparkSession, label)
    names = ["text", "n_chars"]
    while set(names) & set(pages.columns):
        names = [f"{name}_" for name in names]
    located = pages.withColumn("__host", host(F.col("url").cast("string"))).withColumn("html", F.col("html").cast("string"))
    found = work.keep(wrappers(located.select(F.col("__host").alias("host"), "html")))
    paths = found.select(F.col("host").alias("__of"), F.col("paths").alias("__paths"), F.col("template").alias("__template"))
    joined = located.join(paths, F.col("__host") == F.col("__of"), "left")
    texts = joined.withColumn("__text", main_text("html", "__paths", "__template"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c != "html"]
    return texts.select(*kept, F.col("__text").alias(names[0]), F.length("__text").cast("long").alias(names[1]))
