"""The corpus operators: brute-force versions, round trips, held-out accuracy, and odd input."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import (
    decontamination,
    fertility,
    language_id,
    line_dedup,
    linking,
    markup,
    minhash,
    mixing,
    pii,
    queries,
    token_counts,
    url_filters,
    words,
    wrappers,
)
from broadsheet.llm.tables import Workspace

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, found string, key string, a string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")

LOREM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
ROWS = [
    (1, LOREM, "en", "s", 5, "x", "y", "z"),
    (1, LOREM, "en", "s", 5, "x", "y", "z"),
    (2, LOREM + " end", "en", "s", 5, None, None, None),
    (3, None, None, None, None, None, None, None),
    (4, "", "en", "", 0, "", "", ""),
    (5, " \t\n ", "fr", "t", 3, "", "", ""),
    (None, LOREM, None, None, None, None, None, None),
    (6, "word " * 60_000, "en", "t", 300_000, "", "", ""),
    (7, "é😀　日本 " + "ß" * 70_000, "de", None, 1, "", "", ""),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def lower(text):
    return text.translate({i: i + 32 for i in range(65, 91)})


class Sets:
    """Plain union-find."""

    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def test_words_are_those_of_the_regular_expression():
    texts = ["A  bc\td\x0be f　g", "", "x" * 600_000 + " y", None, "ÀÉ ab AB aB"]
    data, offsets = words.text_bytes(pa.array(texts))
    starts, stops, first = words.word_spans(data, offsets, words.NOT_WHITE)
    hashes = words.word_hashes(data, starts, stops, words.FOLDED_VALUES)
    seen = {}
    for text, low, high in zip(texts, first[:-1], first[1:]):
        expected = WORD.findall(text or "")
        assert [data[a:b].tobytes().decode() for a, b in zip(starts[low:high], stops[low:high])] == expected
        for word, value in zip(expected, hashes[low:high].tolist()):
            assert seen.setdefault(lower(word), value) == value
    assert len(set(seen.values())) == len(seen)


def test_near_duplicates_equal_brute_force(documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    sets = {}
    for i, text in rows.items():
        w = WORD.findall(lower(text or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    groups = Sets()
    for a in rows:
        for b in rows:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                groups.join(a, b)
    for r in minhash.near_duplicates(documents).collect():
        assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), groups.find(r.doc_id))
        assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_of_odd_rows(odd, none):
    found = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()}
    assert found[1, 12] == (1, True) and found[2, 13] == (1, False) and found[None, 12] == (1, False)
    assert found[3, 0] == (3, True) and found[4, 0] == (4, True) and found[5, 0] == (5, True)
    assert found[6, 1] == (6, True) and found[7, 1] == (7, True)
    kept = sorted((r.doc_id for r in minhash.representatives(odd).collect()), key=str)
    assert kept.count(1) == 2 and 2 not in kept and {3, 4, 5, 6, 7} <= set(kept)
    assert minhash.near_duplicates(none).count() == 0


def test_estimate_is_near_the_similarity(spark):
    rng = np.random.default_rng(3)
    common, rows = rng.integers(0, 1 << 62, 800).astype(np.uint64), []
    for share in (0.0, 0.5, 0.8, 1.0):
        n = int(800 * share)
        other = np.concatenate([common[:n], rng.integers(0, 1 << 62, 800 - n).astype(np.uint64)])
        both = [minhash.pack(minhash.minima(x, minhash.FACTORS)).tolist() for x in (common, other)]
        rows.append((n / (1600 - n), *both))
    df = spark.createDataFrame(rows, "j double, a array<long>, b array<long>")
    for r in df.select("j", minhash.estimate(F.col("a"), F.col("b")).alias("e")).collect():
        assert abs(r.j - r.e) < 0.17


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(400, 440)]
    groups = Sets()
    for a, b in edges:
        if a != b:
            groups.join(a, b)
    links = spark.createDataFrame(edges, "a long, b long")
    found = {r.item: r.root for r in linking.components(links, Workspace(spark, "t")).collect()}
    assert found == {x: groups.find(x) for x in list(groups.parent)}


def plain_line_dedup(rows, at_least=80):
    """Brute force: all pairs of different lines."""
    occurrences, forms = [], {}
    for i in sorted(rows):
        for place, line in enumerate((rows[i] or "").encode().split(b"\n")):
            form = b" ".join(line.lower().split())
            if len(line.split()) >= line_dedup.MIN_WORDS:
                occurrences.append((i, place, form))
                forms.setdefault(form, {form[k : k + 8] for k in range(len(form) - 7)})
    groups, by_shingle = Sets(), defaultdict(list)
    for form, shingles in forms.items():
        for other, both in Counter(o for s in shingles for o in by_shingle[s]).items():
            if 100 * both >= at_least * (len(shingles) + len(forms[other]) - both):
                groups.join(form, other)
        for s in shingles:
            by_shingle[s].append(form)
    first, dropped = {}, defaultdict(set)
    for i, place, form in occurrences:
        if first.setdefault(groups.find(form), (i, place)) != (i, place):
            dropped[i].add(place)
    return dropped


def test_line_dedup_equals_brute_force(documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    dropped = plain_line_dedup(rows)
    for r in line_dedup.dedup_lines(documents).collect():
        lines = (rows[r.doc_id] or "").split("\n")
        assert r.text == "\n".join(line for k, line in enumerate(lines) if k not in dropped[r.doc_id])
        assert (r.n_lines, r.n_dropped) == (len(lines), len(dropped[r.doc_id]))


def test_line_dedup_of_odd_rows(spark, odd, none):
    found = line_dedup.dedup_lines(odd)
    assert set(odd.columns) <= set(found.columns) and found.count() == len(ROWS)
    texts = {(r.doc_id, r.n_dropped): r.text for r in found.collect()}
    assert texts[1, 0] == LOREM and texts[2, 1] == "" and texts[None, 1] == "" and texts[3, 0] is None
    assert texts[4, 0] == "" and texts[5, 0] == " \t\n "
    lines = "a b c d e f\nA  b c d e\tf\n\nx y\nx y\nz"
    one = spark.createDataFrame([(1, lines)], "doc_id long, text string")
    assert line_dedup.dedup_lines(one).first().text == "a b c d e f\n\nx y\nx y\nz"
    assert line_dedup.dedup_lines(none).count() == 0


def test_decontamination_of_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [(10, "Two THREE, four-five six seven eight nine ten eleven twelve"), (11, "end"), (12, None), (13, "")],
        "item_id long, text string",
    )
    found = {(r.doc_id, r.n_hit): r for r in decontamination.digest(odd, items).collect()}
    assert found[1, 11].n_words == 16 and found[1, 11].n_items == 1 and found[2, 12].n_items == 2
    assert not found[3, 0].contaminated and found[6, 0].n_words == 60_000
    cleaned = decontamination.decontaminate(odd, items)
    assert cleaned.columns == odd.columns and cleaned.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in cleaned.collect()}
    assert texts[2] == "one  thirteen fourteen fifteen sixteen end" and texts[3] is None
    assert decontamination.digest(odd, items.limit(0)).where("contaminated").count() == 0
    assert decontamination.decontaminate(none, items).count() == 0


def test_several_automata_find_what_one_finds(documents, spark, monkeypatch):
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    one = {tuple(r) for r in decontamination.digest(documents, items).collect()}
    monkeypatch.setattr(decontamination, "MAX_WORDS", 500)
    assert {tuple(r) for r in decontamination.digest(documents, items).collect()} == one


def test_language_is_recognised_on_held_out_documents(spark):
    rows = queries.op8_language_id(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    held = rows.where("held_out").join(truth, "doc_id")
    right, n = held.select(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n >= 0.99
    assert rows.where("rejected").count() <= 10


def test_character_probabilities_add_up(spark):
    langs = np.array([0, 0, 1, 1, 1])
    windows = np.concatenate([language_id.packed(np.array([1, 3, 4, 5, 1], dtype=np.uint64), 5), [np.uint64(4)]])
    model = language_id.Model(["x", "y"], langs, windows, np.array([2, 1, 1, 3, 1]))
    every = np.arange(1 << language_id.BITS, dtype=np.uint64)
    total = np.exp(language_id.log_probabilities(every, model.levels, model.floor, 1)).sum(axis=0)
    assert np.allclose(total, 1.0, atol=1e-4)


def test_language_of_odd_rows(odd, none):
    found = {r.doc_id: r for r in language_id.predict(odd).collect()}
    assert found[3].lang_pred == found[4].lang_pred == found[5].lang_pred == "und" and found[3].score == 0
    assert all(0 <= r.score <= 1 for r in found.values())
    assert language_id.predict(none).count() == 0
    assert {r.doc_id for r in language_id.accepted(odd).collect()}.isdisjoint({3, 4, 5})


def test_mixing_meets_targets(documents):
    mixed = mixing.mix(documents).toPandas()
    again = mixing.mix(documents.repartition(7)).toPandas()
    key = ["doc_id", "source", "text_id"]
    assert mixed.sort_values(key).reset_index(drop=True).equals(again.sort_values(key).reset_index(drop=True))
    per = mixed.groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert (per.taken - per.target).abs().max() < 1.001 and (mixed.taken <= 3 * mixed["size"]).all()
    # Brute force: raise one level until the shares use up all words.
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(per.index))}
    held, total = set(), per["size"].sum()
    while True:
        level = (total - sum(3 * per["size"][s] for s in held)) / sum(weights[s] for s in weights if s not in held)
        above = {s for s in weights if s not in held and level * weights[s] > 3 * per["size"][s]}
        if not above:
            break
        held |= above
    for s in weights:
        assert per.target[s] == pytest.approx(3 * per["size"][s] if s in held else level * weights[s])


def test_mixing_of_odd_rows(spark, odd, none):
    mixed = mixing.mix(odd).toPandas()
    assert len(mixed) == len(ROWS) and mixed[mixed.doc_id == 3].taken.tolist() == [0]
    small = spark.createDataFrame([(1, "a " * 10, "x"), (2, "b " * 1000, "y"), (3, "c " * 5, None)], "doc_id long, text string, source string")
    taken = {r.doc_id: (r.target, r.taken) for r in mixing.mix(small).collect()}
    assert taken[1] == (30.0, 30) and taken[3] == (15.0, 15) and taken[2] == (970.0, 970)
    assert mixing.mix(none).count() == 0
    assert set(odd.columns) <= set(mixing.sample(odd).columns)


def test_quality_counts_equal_brute_force(documents):
    rows = {r.doc_id: r.text for r in documents.collect()}
    for r in fertility.judge(documents).collect():
        text = rows[r.doc_id] or ""
        w = WORD.findall(text)
        often = Counter(zip(w, w[1:], w[2:]))
        hit = {k + j for k in range(len(w) - 2) if often[tuple(w[k : k + 3])] > 1 for j in range(3)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        expected = (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r.kept and r.base_failed)


def test_words_are_encoded_like_the_whole_text():
    encoder = fertility._Encoder(fertility.FOLDER, fertility.PIECE_BPE)
    for text in ("One two  thrée", "日本 x퟿ 😀", "a", "  "):
        blanks = " ".join(text.translate(fertility.BLANKS).split(" ")).split()
        assert encoder.tokens(text).tolist() == encoder.model.encode(" ".join(blanks))


def test_quality_of_odd_rows(odd, none):
    found = {r.doc_id: r for r in fertility.judge(odd).collect()}
    assert found[3].n_words == found[4].n_words == found[5].n_words == 0 and found[3].base_failed
    assert found[6].n_repeat_words == 60_000 and not found[6].kept
    assert fertility.judge(none).count() == 0


def test_token_limits_equal_brute_force(documents):
    tokenizer = token_counts.tokenizers.byte_bpe(token_counts.tokenizers.FOLDER, token_counts.tokenizers.BYTE_BPE)
    lengths = [len(tokenizer.encode_ordinary(r.text or "")) for r in documents.collect()]
    rows = token_counts.token_counts(documents).collect()
    assert {r.length: r.n_docs for r in rows} == Counter(lengths)
    for r in rows:
        cut = sum(min(n, r.length) for n in lengths)
        assert (r.docs_within, r.tokens_truncated, r.tokens_lost) == (sum(n <= r.length for n in lengths), cut, sum(lengths) - cut)
        assert r.tokens_within == sum(n for n in lengths if n <= r.length)


def test_token_counts_of_odd_rows(odd, none):
    rows = {r.length: r.n_docs for r in token_counts.token_counts(odd).collect()}
    assert rows[0] == 2 and sum(rows.values()) == len(ROWS)
    assert token_counts.token_counts(none).count() == 0


VALUES = [
    "call +1 (017) 555-7713 or +14155550123 now",
    "ip 233.254.104.120 and 1.2.3.4. v 1.2.3.4.5 300.1.1.1",
    "on 2024-02-29, 31.12.1999 or 05/06/2021; bad 2023-02-30 and 13/13/2020",
    "ssn 123-45-6789 000-12-3456 666-11-1111",
    "card 4111 1111 1111 1111, 4111111111111112 5500-0000-0000-0004",
    "4111111111111111 again",
    None,
    "",
    "12 " * 40_000,
]


def test_pseudonyms_keep_the_format_and_go_back(spark):
    given = spark.createDataFrame(list(enumerate(VALUES)), "doc_id long, text string").withColumn("n_replaced", F.lit("x"))
    made = pii.pseudonymise(given, "secret")
    rows = {r.doc_id: r for r in made.collect()}
    assert [rows[i].n_replaced_ for i in range(9)] == [2, 2, 3, 1, 2, 1, 0, 0, 0]
    for i, text in enumerate(VALUES):
        if text:
            assert re.sub(r"[0-9]+", "0", rows[i].text) == re.sub(r"[0-9]+", "0", text)
    card = re.sub("[^0-9]", "", rows[4].text.split(",")[0])
    assert card == rows[5].text.split()[0] and card != "4" + "1" * 15
    digits = [int(c) for c in reversed(card)]
    assert sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0
    back = pii.pseudonymise(made.drop("n_replaced_"), "secret", back=True)
    assert {r.doc_id: r.text for r in back.collect()} == dict(enumerate(VALUES))
    other = pii.pseudonymise(given, "another").where("doc_id = 5").first().text
    assert other != rows[5].text
    assert pii.pseudonymise(given.limit(0), "k").count() == 0


def test_feistel_is_a_permutation(spark):
    pairs = spark.range(27 * 31).select((F.col("id") % 27).alias("l"), F.floor(F.col("id") / 27).alias("r"))
    out = pairs.select(pii.feistel(F.col("l"), F.col("r"), (27, 31), F.lit("k"), "t").alias("o"))
    assert out.distinct().count() == 27 * 31


def test_url_rules_equal_brute_force(spark):
    rows = queries.op1_url_filters(spark, SF_DIR).collect()
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in rows:
        host, path = re.match(r".*?://([^/?#]*)([^?#]*)", urls[r.page_id]).groups()
        fits = [
            x for x in queries.URL_RULES
            if (host == x.host or host.endswith("." + x.host)) and path.startswith(x.path)
        ]
        best = max(fits, key=lambda x: len(x.name), default=None)
        assert (r.host, r.path, r.rule) == (lower(host), path, best.name if best else None)
        assert best is None or r.verdict == ("block" if best.block else "allow")


def test_url_templates_reject_bad_branches(spark):
    rows = [(f"http://h.org/bad/{i}", 1) for i in range(60)] + [(f"http://h.org/good/{i}.html", 0) for i in range(60)]
    rows += [(f"http://H.org/bad/x{i}?q", None) for i in range(3)] + [(None, None), ("no scheme", None), ("http://h.org", None)]
    df = spark.createDataFrame(rows, "url string, bad int").withColumn("host", F.lit("given"))
    found = url_filters.judge(df, [])
    assert found.count() == len(rows) and found.columns[:3] == ["url", "bad", "host"]
    verdicts = {r.url: r for r in found.collect()}
    assert verdicts["http://h.org/bad/1"].verdict == "block" and verdicts["http://H.org/bad/x1?q"].verdict == "block"
    assert verdicts["http://h.org/good/1.html"].verdict == "allow" and verdicts[None].host_ == ""
    assert url_filters.judge(df.limit(0), queries.URL_RULES).count() == 0


PAGE = """<html><head><title>t</title><script>x="<p>no</p>"</script></head><body><header>H</header>
<nav><ul><li><a href=a>m</a><li>n</ul></nav><div class="cookie-notice">C</div><main><article class=post><h1>Title &amp; more</h1>
<p>One <b>two</b>
 three<br>four<p>Five &eacute;<aside>S</aside><form>F</form></article><div id="comments"><p>Reader</p></div></main>
<div class="ad">A</div><footer>&copy; f</footer></body></html>"""


def test_main_text_of_a_page(spark):
    rows = [(1, "http://h/1", PAGE), (2, "http://h/2", PAGE.replace("One", "Six")), (3, None, None), (4, "x", ""),
            (5, "http://h/3", "plain"), (6, "http://i/", "<div><div class=a><p>x</p></div><p>long text here</p></div>"), (1, "http://h/1", PAGE)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    found = {r.page_id: r for r in wrappers.extract(df).collect()}
    assert found[1].text_ == "Title & more\nOne two three four\nFive é" and found[1].n_chars_ == len(found[1].text_)
    assert found[2].text_.startswith("Title & more\nSix") and found[3].text_ == found[4].text_ == ""
    assert found[5].text_ == "plain" and found[6].text_ == "x\nlong text here"
    assert wrappers.extract(df.limit(0)).count() == 0


def test_alignment_finds_repeats_and_options():
    one = wrappers.of_page(markup.parse("<div><h1>a</h1><p>b</p><p>c</p></div>"))
    two = wrappers.of_page(markup.parse("<div><p>d</p><table><tr><td>e</table></div>"))
    text = wrappers.expression(wrappers.aligned(one, two))
    assert "( <h1> #text </h1> )?" in text and "( <p> #text </p> )+" in text and ")?" in text.split("<table>")[1]


def test_deep_and_broken_markup_is_read_in_linear_time():
    html = "<div>" * 50_000 + "x" + "</b>" * 50_000 + "<b " * 20_000
    assert wrappers.read(markup.parse(html), []) == "x"


def test_extraction_equals_the_article_of_given_pages(spark):
    from html import unescape

    rows = {r.page_id: r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    for r in queries.op4_extraction(spark, SF_DIR).collect():
        article = re.search(r"<article>(.*?)</article>", rows[r.page_id], re.S).group(1)
        parts = [" ".join(unescape(re.sub("<br>|<b>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        assert r.text == "\n".join(x for x in parts if x)


def test_pipeline_stages_take_effect(spark, documents):
    docs, counts = documents, [documents.count()]
    work = Workspace(spark, "t")
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = work.keep(stage(spark, docs, SF_DIR))
        counts.append(docs.count())
        if name != "mixing":
            assert docs.columns == documents.columns
        if name == "near_duplicates":
            assert minhash.near_duplicates(docs).where("not kept").count() == 0
        if name == "line_dedup":
            dropped = plain_line_dedup({r.doc_id: r.text for r in before.collect()})
            assert docs.count() >= before.count() - len(dropped)
    # The last stage returns a row for each pass over a document, three at most.
    assert counts[:-1] == sorted(counts[:-1], reverse=True) and 0 < counts[-1] <= 3 * counts[-2]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert decontamination.digest(docs, items).where("n_hit > 0").count() == 0


def test_pipeline_of_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.collect()
