"""Main text of pages of several layouts, wide, deep, and with text that all pages of a host share."""

import random
import time

import pytest

from broadsheet.llm import markup, wrappers

RNG = random.Random(6)
WORDS = [f"word{i}" for i in range(500)]


def sentence(n=12):
    return " ".join(RNG.choices(WORDS, k=n))


def article(paragraphs):
    return [sentence(5), *[sentence() for _ in range(paragraphs)]]


def marked(blocks):
    return f"<h1>{blocks[0]}</h1>" + "".join(f"<p>{block}</p>" for block in blocks[1:])


# Layouts: what stands around the main text, which is in the place of {}.
LAYOUTS = {
    "article": "<header>Site name / Tagline</header><nav>menu</nav><article>{}</article><aside>more</aside><footer>end</footer>",
    "main": "<div id=top><header><h2>Site</h2></header></div><main class=m><header class=title>{}</header></main><form>x</form>",
    "plain": "<div class=page><div class=site-header><ul class=nav><li>a</li></ul></div><div class=text>{}</div></div>",
    "names": "<article class='has-sidebar ad-free'><div class=share-enabled>{}</div></article><div class=left-sidebar>no</div>",
    "count": "<div class=banner-story><div class=article-with-comment-count>{}</div></div><div class=post-comments>I agree</div>",
    "comments": "<article>{}<section id=comments><article><p>a reader</p></article></section></article>",
    "related": "<article class=full>{}</article><div class=related-posts><article class=card><p>teaser</p></article></div>",
    "table": "<table><tr><td class=menu>menu</td><td>{}</td></tr></table><div class=cookie-banner>We use cookies</div>",
}


@pytest.mark.parametrize("layout", list(LAYOUTS))
def test_layouts(spark, layout):
    expected, rows = {}, []
    for i in range(12):
        blocks = article(1 + i % 4)
        expected[i] = "\n".join(blocks)
        rows.append((i, f"http://{layout}.example/{i}", f"<html><body>{LAYOUTS[layout].format(marked(blocks))}</body></html>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert {row.page_id: row.text for row in wrappers.extract(df).collect()} == expected


def test_two_articles_of_a_page_are_both_read(spark):
    page = "<article class=a><p>first {0} one two three</p></article><article class=b><p>second {0}</p></article>"
    rows = [(i, f"http://two.example/{i}", page.format(i)) for i in range(5)]
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {row.page_id: row.text for row in found} == {i: f"first {i} one two three\nsecond {i}" for i in range(5)}


@pytest.mark.parametrize("n", [199, 201, 5000])
def test_wide_pages(spark, n):
    """Very many different blocks beside the main text, and inside it."""
    rows, expected = [], {}
    for i in range(3):
        inner = [sentence(4) for _ in range(n)]
        beside = "".join(f"<section class=s{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}><a href=x>l</a></section>" for k in range(n))
        main = "".join(f"<div class=x{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}>{text}</div>" for k, text in enumerate(inner))
        rows.append((i, f"http://wide.example/{i}", f"<body><nav>m</nav>{beside}<main class=m>{main}</main></body>"))
        expected[i] = "\n".join(inner)
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {row.page_id: row.text for row in found} == expected


def test_wide_pages_without_a_main_element(spark):
    rows, expected = [], {}
    for i in range(3):
        inner = [sentence(4) for _ in range(400)]
        main = "".join(f"<div id=p{chr(97 + k % 26)}{chr(97 + k // 26)}>{text}</div>" for k, text in enumerate(inner))
        rows.append((i, f"http://w.example/{i}", f"<body><nav>m</nav>{main}<made-up-{i}>tail</made-up-{i}></body>"))
        expected[i] = "\n".join([*inner, "tail"])
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {row.page_id: row.text for row in found} == expected


@pytest.mark.parametrize("around, inside", [(20, 60), (50, 60), (120, 0), (3000, 3000)])
def test_deep_pages(spark, around, inside):
    rows, expected = [], {}
    for i in range(3):
        blocks = article(3)
        deep = "<div>" * inside + marked(blocks[:2]) + "<nav>MENU ITEM</nav>" + "</div>" * inside + f"<p>{blocks[2]}</p><p>{blocks[3]}</p>"
        rows.append((i, f"http://deep.example/{i}", "<div>" * around + f"<article>{deep}</article><nav>MENU</nav>" + "</div>" * around))
        expected[i] = "\n".join(blocks)
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {row.page_id: row.text for row in found} == expected


def test_the_same_block_of_all_pages_is_template(spark):
    notice = "All rights reserved by the owners of this site"
    rows, expected = [], {}
    for i in range(30):
        blocks = article(3)
        expected[i] = "\n".join(blocks)
        odd = f"<div class=legal>{notice}{' indeed' if i == 29 else ''}</div>" if i % 3 else ""
        rows.append((i, f"http://t.example/{i}", f"<article>{marked(blocks)}{odd}</article>"))
    expected = {i: text for i, text in expected.items()}
    few = [(100 + i, f"http://few.example/{i}", f"<article>{marked(article(2))}<div class=legal>{notice}</div></article>") for i in range(4)]
    same = [(200 + i, f"http://same.example/{i}", f"<article><h1>One</h1><p>text of the copy</p><div>{i % 2}</div></article>") for i in range(30)]
    df = spark.createDataFrame(rows[:29] + few + same, "page_id long, url string, html string").repartition(4)
    found = {row.page_id: row.text for row in wrappers.extract(df).collect()}
    assert {i: found[i] for i in range(29)} == {i: expected[i] for i in range(29)}
    # Too few pages tell nothing, and pages that agree in most of their text are copies.
    assert all(found[100 + i].endswith(notice) for i in range(4))
    assert all(found[200 + i] == f"One\ntext of the copy\n{i % 2}" for i in range(30))


def test_another_text_in_the_place_of_template_stays(spark):
    rows = []
    for i in range(25):
        rows.append((i, f"http://p.example/{i}", f"<article>{marked(article(3))}<div class=legal>{'own words' if i == 7 else 'the notice'}</div></article>"))
    found = {row.page_id: row.text for row in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[7].endswith("\nown words") and found[8].endswith("the notice")


def test_a_page_of_asides_by_name_only_is_read(spark):
    df = spark.createDataFrame([(1, "http://a.example/", "<div class=share><p>all there is</p></div><nav>menu</nav>")], "page_id long, url string, html string")
    assert wrappers.extract(df).first().text == "all there is"


def test_names():
    for name in ("sidebar", "left-sidebar", "comment-list", "related-posts", "cookie-banner", "ad", "ad_slot", "post-comments", "nav2"):
        assert markup.is_aside_name(name), name
    for name in ("has-sidebar", "share-enabled", "ad-free", "banner-story", "article-with-comment-count", "shadow", "no-comments", "content"):
        assert not markup.is_aside_name(name), name


def test_partial_wrappers_survive_their_rows():
    page = "<div class=a><h1>t</h1><ul><li>x</li><li>y</li></ul></div>" * 2
    part = wrappers.of_page(markup.parse(page))
    again = wrappers.Part.of_rows(part.to_rows())
    assert again.to_rows() == part.to_rows() and wrappers.expression(again) == wrappers.expression(part)


def test_reading_takes_linear_time():
    html = "".join(f"<div class=c{i}>" for i in range(30_000)) + "<article><p>x</p></article>" * 3000
    started = time.perf_counter()
    assert wrappers.read(markup.parse(html), []).count("x") == 3000
    assert time.perf_counter() - started < 5
