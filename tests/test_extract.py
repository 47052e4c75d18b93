import time
"""Item extraction: site rules on hand-written pages, and a slow tree search on random markup."""

import random
from dataclasses import replace
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from broadsheet.functions import html as reader
from broadsheet.functions.html import AROUND, INSIDE, INSIDE_ELSE_AROUND
from broadsheet.operators.extract import (
    AKHBARONA,
    AL_JAZEERA,
    BATCH_RULES,
    BBC_NEWS,
    HESPRESS,
    HESPRESS_LIVE,
    STREAM_RULES,
    failed_pages,
    gathered,
    read_items,
    to_articles,
    utc_iso,
    matched_pages,
    unmatched_hosts,
)
from broadsheet.schema import ARTICLE_FIELDS


def items(page, item_tag, item_class=None, title_tag=None, link=INSIDE, cap=None):
    rule = dict(item_tag=item_tag, item_class=item_class, title_tag=title_tag, link=link, cap=cap)
    return [(item["title"], item["href"]) for item in reader._read_items(page, rule)]


# -- markup -------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, expected",
    [
        ("<h2>Foo <b>bar</b></h2>", [("Foobar", None)]),
        ("<h2> a &amp; b&nbsp;</h2>", [("a & b", None)]),
        ("<h2>a&&&amp</h2>", [("a&&&", None)]),
        ("<h2>&eacute;&hellip x &foo; &#39;&#x2019;&</h2>", [("é… x &foo '\u2019&", None)]),
        ("<h2>a &lt;b&gt; c</h2>", [("a <b> c", None)]),
        ("<h2>a<!-- c --> b</h2>", [("ab", None)]),
        ("<h2>a<script>var x = '</p>';</script>b<style>p{}</style></h2>", [("ab", None)]),
        ("<H2>up</H2><h2>low</h2>", [("up", None), ("low", None)]),
        ("<h2>never closed", [("never closed", None)]),
        ("<div><h2>closed by parent</div>outside", [("closed by parent", None)]),
        ("<h2>a</b>b</h2>c", [("ab", None)]),
        ("<h2>a<br>b<br/>c<img src=x>d</h2>", [("abcd", None)]),
        ("<h2/>x", [("", None)]),
        ("<h2>out<h2>in</h2></h2>", [("outin", None), ("in", None)]),
        ("<!-- <h2>no</h2> --><h2>yes</h2>", [("yes", None)]),
        ("<h22>no</h22><h2x>no</h2x>", []),
        ("", []),
        ("<", []),
        ("<h2", []),
        ("<h2>a <template>t</template>b</h2>", [("ab", None)]),
    ],
)
def test_titles(page, expected):
    assert items(page, "h2") == expected


def test_class_is_one_token():
    page = '<div class="card big">a</div><div class="cards">b</div><div class="x\tcard">c</div><div>d</div>'
    assert items(page, "div", "card") == [("a", None), ("c", None)]


def test_links():
    page = '<a href="/out"><h2>t<a href="/in">x</a></h2></a>'
    assert items(page, "h2", link=INSIDE) == [("tx", "/in")]
    assert items(page, "h2", link=AROUND) == [("tx", "/out")]
    assert items(page, "h2", link=INSIDE_ELSE_AROUND) == [("tx", "/in")]
    assert items('<a href="/out"><h2>t</h2></a>', "h2", link=INSIDE_ELSE_AROUND) == [("t", "/out")]
    assert items('<a href="/out"><h2>t<a>x</a></h2></a>', "h2", link=INSIDE_ELSE_AROUND) == [("tx", None)]
    assert items('<a href="/1"><a href="/2"><h2>t</h2></a></a>', "h2", link=AROUND) == [("t", "/2")]
    assert items('<a href="/1"></a><h2>t</h2>', "h2", link=AROUND) == [("t", None)]
    assert items('<h2><a href="/a">x</a><a href="/b">y</a></h2>', "h2") == [("xy", "/a")]
    assert items('<h2><a href="/?a=1&amp;b=2">x</a></h2>', "h2") == [("x", "/?a=1&b=2")]
    assert items("<h2><a href>x</a></h2>", "h2") == [("x", "")]


def test_cap_counts_untitled_items():
    page = "".join(f"<article>{'' if i == 1 else f'<h3>t{i}</h3>'}</article>" for i in range(5))
    assert items(page, "article", title_tag="h3", cap=3) == [("t0", None), (None, None), ("t2", None)]


def test_nested_items_share_a_title():
    page = "<div class=card><div class=card><h3>a</h3></div><h3>b</h3></div>"
    assert items(page, "div", "card", "h3") == [("a", None), ("a", None)]


# -- against a tree -----------------------------------------------------------------------------


class Node:
    def __init__(self, name, attrs, parent):
        self.name, self.attrs, self.parent, self.children = name, attrs, parent, []

    def walk(self):
        for child in self.children:
            yield child
            if isinstance(child, Node):
                yield from child.walk()

    def nodes(self, name):
        return [node for node in self.walk() if isinstance(node, Node) and node.name == name]

    def ancestors(self):
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def text(self):
        strings = [(node, child) for node in [self, *self.walk()] if isinstance(node, Node) for child in node.children]
        in_order = [child for child in self.walk() if not isinstance(child, Node)]
        owner = {id(child): node for node, child in strings if not isinstance(child, Node)}
        muted = reader.MUTED_TAGS
        kept = [
            s.value.strip()
            for s in in_order
            if not any(n.name in muted for n in [owner[id(s)], *owner[id(s)].ancestors()])
        ]
        return "".join(kept)


class Text:
    def __init__(self, value):
        self.value = value


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)
        self.run = False

    def handle_data(self, data):
        if self.run:
            self.at.children[-1].value += data
        else:
            self.at.children.append(Text(data))
        self.run = True

    def handle_comment(self, data):
        self.run = False

    def handle_starttag(self, tag, attrs):
        self.run = False
        node = Node(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in reader.VOID_TAGS:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in reader.VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.run = False
        node = self.at
        while node.parent is not None and node.name != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent


def tree_items(page, item_tag, item_class, title_tag, link, cap):
    builder = TreeBuilder()
    builder.feed(page)
    builder.close()
    found = [
        node
        for node in builder.root.nodes(item_tag)
        if item_class is None or item_class in (node.attrs.get("class") or "").split()
    ][:cap]
    result = []
    for node in found:
        titles = [node] if title_tag is None else node.nodes(title_tag)[:1]
        inner = node.nodes("a")[:1]
        outer = [n for n in node.ancestors() if n.name == "a"][:1]
        links = {INSIDE: inner, AROUND: outer, INSIDE_ELSE_AROUND: inner or outer}[link]
        href = (links[0].attrs["href"] or "") if links and "href" in links[0].attrs else None
        result.append((titles[0].text() if titles else None, href))
    return result


PARTS = [
    "<div>", '<div class="card">', '<div class="card x">', "</div>", "<h3>", "</h3>", "<h2>", "</h2>", "<b>", "</b>",
    '<a href="/x">', '<a href="http://y">', "<a>", "</a>", "<article>", "</article>", "<br>", "<p>", "</p>", "<p/>",
    " t ", "u", "&amp;", "<!-- <h3>z</h3> -->", "<script>if (a<b) '<h3>'</script>", "<template>", "</template>",
    "\n", "<img src='<h2>'>", "< ", "<h3 class='card'>", "<rp>", "</rp>",
]


def test_random_markup_equals_tree_search():
    rng = random.Random(11)
    rules = [
        ("article", None, "h3", INSIDE), ("h3", None, None, AROUND), ("div", "card", "h3", INSIDE),
        ("h2", None, None, INSIDE_ELSE_AROUND), ("p", None, None, INSIDE), ("a", None, None, INSIDE_ELSE_AROUND),
        ("div", None, "div", AROUND), ("br", None, None, AROUND),
    ]
    found = 0
    for _ in range(4000):
        page = "".join(rng.choices(PARTS, k=rng.randrange(1, 40)))
        for item_tag, item_class, title_tag, link in rules:
            cap = rng.choice([None, 1, 2, 5])
            expected = tree_items(page, item_tag, item_class, title_tag, link, cap)
            assert items(page, item_tag, item_class, title_tag, link, cap) == expected, page
            found += len(expected)
    assert found > 10000


# -- site rules ---------------------------------------------------------------------------------


def page_of(parts):
    return "<html><body><nav><a href='/home'>home</a></nav>" + "".join(parts) + "</body></html>"


def site_rows(spark, rule, html):
    pages = spark.createDataFrame([(1, f"https://{rule.host}/news", html)], "page_id long, url string, html string")
    return to_articles(read_items(pages, [rule])).collect()


def test_article_cards(spark):
    links = ["<a href='/a'>m</a>", "<a href='https://x.org/a'>m</a>", "<a href='//x.org/a'>m</a>", "<a>m</a>", ""]
    parts = [f"<article>{links[i % 5]}<h3>Title {i}</h3></article>" for i in range(9)]
    parts += ["<article><p>untitled</p></article>", "<article><h3>late</h3></article>"]
    rows = site_rows(spark, replace(AL_JAZEERA, cap=10), page_of(parts))
    assert [row.title for row in rows] == [f"Title {i}" for i in range(9)]
    assert [row.url for row in rows[:5]] == ["https://www.aljazeera.com/a", "", "https://www.aljazeera.com//x.org/a", "", ""]
    first = rows[0]
    assert first.content == "Article preview: Title 0..." and first.author == "Al Jazeera Staff"
    assert (first.category, first.source, first.country) == ("News", "Al Jazeera", "International")


def test_empty_title_element_is_kept_for_the_quality_filter(spark):
    rows = site_rows(spark, AL_JAZEERA, "<article><h3> </h3></article>")
    assert [(row.title, row.content) for row in rows] == [("", "Article preview: ...")]


def test_headings_with_link_around(spark):
    parts = ["<a href='/news/1'><h3>One</h3></a>", "<a href='https://x.org/2'><h3>Two</h3></a>", "<h3>Three</h3>", "<h3> </h3>", "<a><h3>Five</h3></a>"]
    parts += [f"<h3>more {i}</h3>" for i in range(8)]
    rows = site_rows(spark, replace(BBC_NEWS, cap=10), page_of(parts))
    assert [row.title for row in rows] == ["One", "Two", "Three", "Five"] + [f"more {i}" for i in range(5)]
    assert [row.url for row in rows[:4]] == ["https://www.bbc.com/news/1", "https://x.org/2", "", ""]
    assert rows[0].content == "BBC News article: One..."


@pytest.mark.parametrize("rule, cap, content", [(HESPRESS, 8, "Hespress article: T0..."), (HESPRESS_LIVE, 5, "Hespress streaming content for: T0")])
def test_cards(spark, rule, cap, content):
    parts = ["<div class='cards'><h3>no</h3></div>"]
    parts += [f"<div class='card big'><h3>T{i}</h3><a href='/{i}'>m</a></div>" for i in range(12)]
    assert len(site_rows(spark, rule, page_of(parts))) == 12
    rows = site_rows(spark, replace(rule, cap=cap), page_of(parts))
    assert [row.title for row in rows] == [f"T{i}" for i in range(cap)]
    assert rows[0].url == "/0" and rows[0].content == content and rows[0].country == "Maroc"


def test_headings_with_link_inside_or_around(spark):
    parts = ["<h2><a href='/in'>A</a></h2>", "<a href='/out'><h2>B</h2></a>", "<a href='/out'><h2><a>C</a></h2></a>", "<h2></h2>", "<h2>E</h2>", "<h2>F</h2>"]
    rows = site_rows(spark, AKHBARONA, page_of(parts))
    assert [(row.title, row.url) for row in rows] == [("A", "/in"), ("B", "/out"), ("C", ""), ("E", ""), ("F", "")]
    assert rows[0].content == "Akhbarona article: A"


def test_sites_in_one_pass_with_counts(spark):
    pages = spark.createDataFrame(
        [
            (1, "https://www.aljazeera.com/", "<article><h3>a</h3></article>" * 3),
            (2, "https://www.bbc.com/news", "<h3>b</h3><h3>c</h3>"),
            (3, "https://en.hespress.com/", "nothing here"),
            (4, "https://elsewhere.org/", "<h3>d</h3>"),
            (5, "not a url", "<h3>d</h3>"),
            (6, "https://www.bbc.com/x", None),
            (7, None, "<h3>d</h3>"),
        ],
        "page_id long, url string, html string",
    )
    rows, counts = gathered(read_items(pages, BATCH_RULES), BATCH_RULES)
    articles = to_articles(rows)
    assert articles.columns == ARTICLE_FIELDS
    assert len({row.id for row in articles.collect()}) == 5
    assert counts.get == {"failed_pages": 0, "total": 5, "Al Jazeera": 3, "BBC News": 2, "Hespress": 0}


def test_a_bad_page_is_reported_and_the_others_go_on(monkeypatch):
    rule = dict(item_tag="h2", item_class=None, title_tag=None, link=INSIDE, cap=None)

    def fail(html, rule):
        raise ValueError("broken")

    assert reader._read_page("<h2>a</h2>", rule)["error"] is None
    monkeypatch.setattr(reader, "_read_items", fail)
    assert reader._read_page("<h2>a</h2>", rule) == {"items": [], "error": "ValueError: broken"}


def test_error_rows_are_counted_not_stored(spark):
    pages = spark.createDataFrame([(1, "https://www.bbc.com/", "<h3>a</h3>")], "page_id long, url string, html string")
    good = read_items(pages, BATCH_RULES)
    nothing = F.lit(None)
    failed = good.withColumns(
        {"pos": nothing.cast("int"), "title": nothing.cast("string"), "href": nothing.cast("string"), "error": F.lit("E")}
    )
    rows, counts = gathered(good.unionByName(failed), BATCH_RULES)
    assert to_articles(rows).count() == 1
    assert (counts.get["failed_pages"], counts.get["total"]) == (1, 1)


def test_fetch_time(spark):
    stamps = ["2026-05-01 10:11:12.123456", "2026-05-01 10:11:12", "2026-05-01 10:11:12.5"]
    df = spark.createDataFrame([(s,) for s in stamps], "s string")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = [row[0] for row in df.select(utc_iso((F.concat("s", F.lit("Z"))).cast("timestamp"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == ["2026-05-01T10:11:12.123456", "2026-05-01T10:11:12", "2026-05-01T10:11:12.500000"]


def test_rules_are_told_apart_by_host():
    assert len({rule.host for rule in BATCH_RULES}) == 3 and len({rule.host for rule in STREAM_RULES}) == 2
    assert replace(HESPRESS, content_before=HESPRESS_LIVE.content_before, content_after="") == HESPRESS_LIVE


def test_pages_without_a_rule_are_reported(spark):
    urls = ["https://www.bbc.com/a", "https://WWW.BBC.com/b", "https://bbc.com/", "no url", None]
    pages = spark.createDataFrame([(url, "<h3>t</h3>") for url in urls], "url string, html string")
    found = {row.host: (row.pages, row.matched) for row in matched_pages(pages, BATCH_RULES).collect()}
    assert found == {"www.bbc.com": (2, True), "bbc.com": (1, False), None: (2, False)}
    assert read_items(pages.withColumn("page_id", F.lit(1)), BATCH_RULES).where("pos is not null").count() == 2


def test_unclosed_and_stray_tags_take_linear_time():
    html = "<b>" * 100_000 + "</i>" * 100_000 + "<h2>t</h2>"
    started = time.perf_counter()
    assert items(html, "h2") == [("t", None)]
    assert time.perf_counter() - started < 5


@pytest.mark.parametrize(
    "page, rule, expected",
    [
        ("<div class=c>" * 100_000 + "x", dict(item_tag="div", item_class="c"), ("x", None)),
        ("<div><h3>t</h3>" * 100_000 + "<a href=/z>x", dict(item_tag="div", title_tag="h3"), ("t", "/z")),
        ("<div>" * 100_000 + "<h3>t</h3><a href=/z></a>" + "</div>" * 100_000, dict(item_tag="div", title_tag="h3"), ("t", "/z")),
        ("<a href=/z>" * 100_000 + "<h2>x" * 3, dict(item_tag="h2", link=AROUND), ("xxx", "/z")),
    ],
)
def test_deeply_nested_items_take_linear_time(page, rule, expected):
    started = time.perf_counter()
    found = items(page, **rule)
    assert time.perf_counter() - started < 8
    assert found[0] == expected and len(found) in (100_000, 3)


def test_unmatched_and_failed_pages_have_rows_of_their_own(spark, monkeypatch):
    read = reader._read_items

    def fail(html, rule):
        if "poison" in html:
            raise ValueError("broken")
        return read(html, rule)

    monkeypatch.setattr(reader, "_read_items", fail)
    pages = spark.createDataFrame(
        [
            (1, "https://www.bbc.com/", "<h3>a</h3><h3>b</h3>"),
            (2, "https://www.bbc.com/bad", "<h3>poison</h3>"),
            (3, "https://elsewhere.org/", "<h3>c</h3>"),
            (4, "https://elsewhere.org/x", None),
            (5, None, "<h3>d</h3>"),
            (6, "https://www.bbc.com/empty", None),
        ],
        "page_id long, url string, html string",
    )
    found = read_items(pages, BATCH_RULES, unread=True)
    assert [tuple(row) for row in failed_pages(found).collect()] == [(2, "https://www.bbc.com/bad", "<h3>poison</h3>", "ValueError: broken")]
    assert {row.host: row.pages for row in unmatched_hosts(found).collect()} == {"elsewhere.org": 2, None: 1}
    assert sorted(row.title for row in to_articles(found).collect()) == ["a", "b"]
    assert read_items(pages, BATCH_RULES).count() == 3


def test_items_are_given_away_part_by_part(spark, monkeypatch):
    """A task holds the items of a part of a batch: the parts of one batch are read in turn, and none is lost."""
    from broadsheet.functions import batches

    monkeypatch.setattr(batches.parts, "__defaults__", (200,))
    pages = [(n, None if n % 5 == 0 else "<h3>t%d</h3>" % n * (n % 7)) for n in range(60)]
    rule = F.struct(*[F.lit(v).cast("int" if n == "cap" else "string").alias(n) for n, v in (
        ("item_tag", "h3"), ("item_class", None), ("title_tag", None), ("link", INSIDE), ("cap", None)
    )])
    df = spark.createDataFrame(pages, "page_id long, html string").coalesce(1)
    read = df.select("page_id", reader.page_items(F.col("html"), rule).alias("page"))
    found = {row.page_id: [item.title for item in row.page["items"]] for row in read.collect()}
    assert found == {n: [] if n % 5 == 0 else [f"t{n}"] * (n % 7) for n, _ in pages}


def test_parts_are_bounded_and_hold_every_row_once():
    import pyarrow as pa

    from broadsheet.functions.batches import ROW_BYTES, parts

    texts = pa.array(["x" * n if n % 3 else None for n in range(300)] + ["y" * 5000] + [""] * 100)
    found = list(parts(texts, 1000))
    assert [row for part in found for row in range(part.start, part.stop)] == list(range(len(texts)))
    for part in found:
        size = sum(len(text or "") + ROW_BYTES for text in texts[part].to_pylist())
        assert size <= 1000 or part.stop - part.start == 1
    assert list(parts(texts[:0])) == [] and len(list(parts(pa.array([""] * 100), 1000))) > 1
    assert list(parts(texts[250:], 1000))[0].start == 0
