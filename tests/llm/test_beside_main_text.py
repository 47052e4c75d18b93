"""Text beside a dominant element of the main text is kept."""

import re

from broadsheet.llm import wrappers

BODY = "body " * 100


def page(inner):
    return f"<html><body><nav>menu</nav><div class=top><a href=x>link</a></div>{inner}</body></html>"


def test_text_beside_a_dominant_element_stays(spark):
    parts = f"<p>lead {{0}}</p><div><div>{BODY}<p>deep</p></div><p>beside</p></div><ul><li>one</li><li>two</li></ul>"
    shells = {"article": "<article>{}</article>", "main": "<main>{}</main>", "plain": "<div class=c>{}</div>"}
    rows = [(i, f"http://{h}/{i}", page(shell.format(parts.format(i)))) for h, shell in shells.items() for i in range(4)]
    # A page with most of its text beside the element that dominates its host.
    rows += [(9, f"http://{h}/9", page(shell.format(f"<p>{'much ' * 300}</p><div>{'few ' * 9}</div>"))) for h, shell in shells.items()]
    found = wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {r.url: r.text for r in found}
    for _, url, html in rows:
        inner = re.search(r"</a></div>(.*)</body>", html).group(1)
        expected = [x for x in (" ".join(x.split()) for x in re.split("<[^>]*>", inner)) if x]
        assert texts[url].split("\n") == expected
