"""HTML pages as small trees of blocks: the common form in which pages of a host are aligned."""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, field
from html import unescape

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of HTML: elements without content, elements of running text, and elements that end an open one.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike"
    " strong sub sup time tt u var wbr".split()
)
PARAGRAPH_ENDS = frozenset(
    "address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tr td th ul".split()
)
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# What is never main text: by element, by role, and by class or id. A name counts if it is one of the words, or ends in
# one behind words of place, or begins with one before words for a container: what else stands in a name may be anything,
# as in "has-sidebar" or "ad-free". A header is one of the page unless it is inside the main text.
ASIDE_TAGS = frozenset(
    "nav footer aside form head button select option datalist dialog svg math object audio video canvas map menu"
    " input template noscript iframe".split()
)
ASIDE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())
ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo promotion sidebar aside menu nav navbar navigation"
    " breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices banner popup modal overlay"
    " newsletter subscribe subscription signup share sharing social related recommended comment comments disqus"
    " respond replies widget pagination pager skip toolbar topbar".split()
)
PLACE_WORDS = frozenset(
    "site page main post article entry blog global primary secondary left right top bottom upper lower side inner outer"
    " sticky fixed floating mobile desktop js the my user reader readers email mail".split()
)
CONTAINER_WORDS = frozenset(
    "area bar block body box button buttons card cards center column columns container content group holder icons inner"
    " item items left link links list main news panel posts row right section slot stories articles unit text title top"
    " bottom widget wrap wrapper zone form thread trail".split()
)
MAIN_TAGS = frozenset(("article", "main"))

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|title|noscript|iframe|template|xmp)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:"[^"]*+"|'[^']*+'|[^'">])*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NUMBER = re.compile(r"[0-9]+")
NOT_WORD = re.compile(r"[^a-z]+")


@dataclass(slots=True)
class Element:
    """An element of block level, or the text between such elements (``key`` is ``#``)."""

    tag: str
    key: str
    aside: str = ""  # why this is no main text: "tag", "words", or nothing
    children: list[Element] = field(default_factory=list)
    text: str = ""
    linked: int = 0  # characters of the text inside links


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(source)} if "=" in source or source.strip() else {}


def _element(tag: str, source: str) -> Element:
    attributes = _attributes(source) if source else {}
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().strip()
    key = f"{tag}.{NUMBER.sub('0', ' '.join(names.split()))}" if names else tag
    aside = ""
    if tag in ASIDE_TAGS or attributes.get("role", "").lower() in ASIDE_ROLES:
        aside = "tag"
    elif "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        aside = "tag"
    elif names and tag not in ("html", "body") and any(map(is_aside_name, names.split())):
        aside = "words"
    return Element(tag, key, aside)


def is_aside_name(name: str) -> bool:
    """Whether a class or id names something that is no main text."""
    parts = [part for part in NOT_WORD.split(name) if part]
    if not parts or ASIDE_WORDS.isdisjoint(parts):
        return False
    last = parts[-1] in ASIDE_WORDS and all(part in ASIDE_WORDS or part in PLACE_WORDS for part in parts[:-1])
    first = parts[0] in ASIDE_WORDS and all(part in ASIDE_WORDS or part in CONTAINER_WORDS for part in parts[1:])
    return last or first


def parse(html: str | None) -> Element:
    """The tree of a page. Open and stray tags are read the way browsers do; time is linear in the page."""
    root = Element("html", "html")
    stack = [root]
    open_tags: dict[str, int] = {"html": 1}
    doubted: list[Element] = []  # open elements that are asides by their name only
    pieces: list[tuple[str, bool]] = []
    links = 0

    def flush() -> None:
        nonlocal pieces
        if pieces:
            text = " ".join("".join(piece for piece, _ in pieces).split())
            if text:
                linked = sum(len(piece) for piece, in_link in pieces if in_link)
                stack[-1].children.append(Element("#", "#", text=text, linked=min(linked, len(text))))
            pieces = []

    def push(element: Element) -> None:
        stack[-1].children.append(element)
        stack.append(element)
        open_tags[element.tag] = open_tags.get(element.tag, 0) + 1
        if element.aside == "words":
            doubted.append(element)

    def pop() -> None:
        element = stack.pop()
        open_tags[element.tag] -= 1
        if doubted and doubted[-1] is element:
            doubted.pop()

    def close(names: set[str], limits: set[str]) -> None:
        """End the innermost open element of ``names`` that lies inside the innermost of ``limits``."""
        if not any(open_tags.get(name) for name in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in names:
                while len(stack) > depth:
                    pop()
                return
            if tag in limits:
                return

    if not html:
        return root
    at = 0
    end = html.rfind(">") + 1  # no tag ends behind it
    for match in TOKEN.finditer(html, 0, end):
        if match.start() > at:
            text = html[at : match.start()]
            pieces.append((unescape(text) if "&" in text else text, links > 0))
        at = match.end()
        name = match[3] or match[6]
        if name is None:
            continue
        tag = name.lower()
        closing = bool(match[2] or match[5])
        source = match[4] if match[3] else match[7]
        if tag == "br":
            pieces.append((" ", False))
            continue
        if tag in INLINE:
            if tag == "a":
                links = 0 if closing else 1
            if closing and open_tags.get(tag):
                flush()
                close({tag}, PARAGRAPH_ENDS)
            elif not closing and source:
                element = _element(tag, source)
                if element.aside:
                    flush()
                    push(element)
            continue
        flush()
        if closing:
            links = 0
            if open_tags.get(tag):
                while stack[-1].tag != tag:
                    pop()
                if len(stack) > 1:
                    pop()
            continue
        if tag in ("html", "body"):
            continue
        links = 0
        if tag in PARAGRAPH_ENDS:
            close({"p"}, {"article", "section", "div", "td", "th", "li", "blockquote", "main"})
        if tag in ENDS:
            close(*ENDS[tag])
        element = _element(tag, source)
        if tag in MAIN_TAGS and not element.aside:
            # A name does not make an aside of what holds the main text.
            while doubted:
                doubted.pop().aside = ""
        if tag in VOID:
            continue
        if tag == "header" and not element.aside and not any(open_tags.get(main) for main in MAIN_TAGS):
            element.aside = "words"
        push(element)
    rest = html[at:]
    if rest:
        # A tag that the page's end cuts off is no text.
        cut = re.search(r"<[a-zA-Z/!][^>]*\Z", rest)
        rest = rest[: cut.start()] if cut else rest
        pieces.append((unescape(rest) if "&" in rest else rest, links > 0))
    flush()
    return root


def blocks(element: Element, out: list[str], named: bool = True) -> list[str]:
    """Texts of the blocks below an element in page order, without what is no main text; ``named`` tells whether
    the names of elements count for that."""
    todo = [element]
    while todo:
        node = todo.pop()
        if node.key == "#":
            out.append(node.text)
        elif not node.aside or node is element or not named and node.aside == "words":
            todo.extend(reversed(node.children))
    return out
