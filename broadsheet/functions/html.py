"""Item extraction from HTML: the one place that needs Python, fed in Arrow batches.

A page is read by the standard library's HTML parser. The element stack follows the usual lenient
rules: an end tag closes the nearest open element of its name and all inside it, and is ignored when
there is none; whatever is open at the end of the page closes there.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from html import entities, unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions.batches import parts

# Executors then need no copy of this package to run the extractor.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Elements without content, and elements whose text is no part of a title.
VOID_TAGS = frozenset(
    """
    area base basefont bgsound br col command embed frame hr image img input isindex keygen link
    menuitem meta nextid param source spacer track wbr
    """.split()
)
MUTED_TAGS = frozenset("rp rt script style template".split())

# Where an item's link is looked for.
INSIDE = "inside"
AROUND = "around"
INSIDE_ELSE_AROUND = "inside_else_around"

_ITEM = pa.struct([("pos", pa.int32()), ("title", pa.string()), ("href", pa.string())])
_RESULT = pa.struct([("items", pa.list_(_ITEM)), ("error", pa.string())])

RESULT = T.StructType(
    [
        T.StructField(
            "items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("pos", T.IntegerType()),
                        T.StructField("title", T.StringType()),
                        T.StructField("href", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("error", T.StringType()),
    ]
)


class _Complete(Exception):
    """The rest of the page cannot change the result."""


class _Item:
    """An item, whose title is the texts of the page from ``start`` up to ``stop``."""

    __slots__ = ("depth", "start", "stop", "inside", "around")

    def __init__(self, depth: int, around: tuple | None):
        self.depth = depth
        self.start = self.stop = None
        self.inside = None  # (href,) of the first link inside
        self.around = around  # (href,) of the nearest link around


class _ItemReader(HTMLParser):
    """Every event costs the same however many items are open.

    The texts of the page are kept once, and items hold places in them. The open items are a stack; those that still
    lack a link or a title are its upper part, as a link or title element serves all that are open.
    """

    def __init__(self, rule: dict, candidates: int):
        super().__init__(convert_charrefs=False)
        self.tag = rule["item_tag"]
        self.css_class = rule["item_class"]
        self.title_tag = rule["title_tag"]
        self.cap = rule["cap"]
        self.candidates = candidates  # item start tags still to come, at most
        self.open = []
        self.open_names = Counter()
        self.links = []  # (depth, href) of the open links
        self.muted = 0
        self.text = []
        self.texts = []
        self.items = []
        self.live = []
        self.unlinked = []  # open items without a link so far
        self.untitled = []  # open items without a title so far
        self.titling = {}  # depth of an open element -> the items whose title it is

    def updatepos(self, i, j):
        return j  # line numbers are not needed

    # -- events ---------------------------------------------------------------------------------

    def handle_data(self, data):
        self.text.append(data)

    def handle_entityref(self, name):
        # A known name counts with or without its semicolon; an unknown one stays, less the semicolon.
        self.text.append(entities.html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        self.text.append(unescape(f"&#{name};"))

    def unknown_decl(self, data):
        self.flush()
        if data.upper().startswith("CDATA["):
            self.text.append(data[6:])
            self.flush()

    def handle_comment(self, data):
        self.flush()

    def handle_decl(self, decl):
        self.flush()

    def handle_pi(self, data):
        self.flush()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_starttag(self, tag, attrs):
        self.flush()
        depth = len(self.open) + 1
        href = None
        if tag == "a":
            href = next((value or "" for name, value in reversed(attrs) if name == "href"), None)
            for item in self.unlinked:
                item.inside = (href,)
            self.unlinked.clear()
        if tag == self.title_tag:
            self.begin_titles(self.untitled, depth)
            self.untitled = []
        if tag == self.tag:
            self.candidates -= 1
            if (self.cap is None or len(self.items) < self.cap) and self.has_class(attrs):
                item = _Item(depth, self.links[-1][1:] if self.links else None)
                self.items.append(item)
                self.live.append(item)
                self.unlinked.append(item)
                if self.title_tag is None:
                    self.begin_titles([item], depth)
                else:
                    self.untitled.append(item)
        self.open.append(tag)
        self.open_names[tag] += 1
        self.muted += tag in MUTED_TAGS
        if tag == "a":
            self.links.append((depth, href))
        if tag in VOID_TAGS:
            self.pop()

    def handle_endtag(self, tag):
        self.flush()
        if self.open_names[tag]:
            while self.pop() != tag:
                pass

    # -- state ----------------------------------------------------------------------------------

    def has_class(self, attrs) -> bool:
        if self.css_class is None:
            return True
        value = next((value or "" for name, value in reversed(attrs) if name == "class"), "")
        return self.css_class in value.split()

    def begin_titles(self, items, depth):
        for item in items:
            item.start = len(self.texts)
        if items:
            self.titling.setdefault(depth, []).extend(items)

    def end_titles(self, depth):
        for item in self.titling.pop(depth, ()):
            item.stop = len(self.texts)

    def flush(self):
        if not self.text:
            return
        text = "".join(self.text).strip()
        self.text.clear()
        if text and not self.muted and self.titling:
            self.texts.append(text)

    def pop(self) -> str:
        depth = len(self.open)
        tag = self.open.pop()
        self.open_names[tag] -= 1
        self.muted -= tag in MUTED_TAGS
        if self.links and self.links[-1][0] == depth:
            self.links.pop()
        self.end_titles(depth)
        if self.live and self.live[-1].depth == depth:
            item = self.live.pop()
            for waiting in (self.unlinked, self.untitled):
                if waiting and waiting[-1] is item:
                    waiting.pop()
            self.stop_when_complete()
        return tag

    def stop_when_complete(self):
        full = self.cap is not None and len(self.items) >= self.cap
        if not self.live and (full or self.candidates <= 0):
            raise _Complete

    def title(self, item: _Item) -> str | None:
        return None if item.start is None else "".join(self.texts[item.start : item.stop])


def _read_items(html: str, rule: dict) -> list[dict]:
    # The case-sensitive '<' in front keeps this search fast.
    candidates = len(re.findall(rf"<(?i:{re.escape(rule['item_tag'])})(?=[\s/>])", html))
    reader = _ItemReader(rule, candidates)
    if candidates:
        try:
            reader.feed(html)
            reader.close()
            reader.flush()
        except _Complete:
            pass
    found = []
    for pos, item in enumerate(reader.items):
        link = None
        if rule["link"] in (INSIDE, INSIDE_ELSE_AROUND):
            link = item.inside
        if link is None and rule["link"] in (AROUND, INSIDE_ELSE_AROUND):
            link = item.around
        found.append({"pos": pos, "title": reader.title(item), "href": link[0] if link else None})
    return found


def _read_page(html: str | None, rule: dict | None) -> dict:
    if html is None or rule is None:
        return {"items": [], "error": None}
    try:
        return {"items": _read_items(html, rule), "error": None}
    except Exception as error:  # one bad page must not stop the others
        return {"items": [], "error": f"{type(error).__name__}: {error}"}


def page_items(html: Column, rule: Column) -> Column:
    """``struct<items: array<struct<pos, title, href>>, error>`` of a page under a rule.

    ``rule`` is a struct of ``item_tag, item_class, title_tag, link, cap``. ``title`` is null when
    the item lacks the title element, ``href`` when there is no link or the link has no target.
    Pages without the item's tag are told apart inside the JVM and never sent to Python.
    """

    @F.arrow_udf(RESULT)
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        # The items of a part are given away before the next one is read.
        for pages, rules in batches:
            for part in parts(pages):
                read = [_read_page(*row) for row in zip(pages[part].to_pylist(), rules[part].to_pylist())]
                yield pa.array(read, type=_RESULT)

    has_tag = F.contains(F.lower(html), F.concat(F.lit("<"), rule["item_tag"]))
    return read(F.when(has_tag, html), rule)
