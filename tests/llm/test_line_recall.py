"""Line dedup with every line against brute force, and how many linked pairs share a band."""

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa

from broadsheet.llm import line_dedup


def forms_of(texts):
    """``(doc, place, comparable form)`` of all lines but blank ones."""
    for doc in sorted(texts):
        for place, line in enumerate((texts[doc] or "").encode().split(b"\n")):
            if line.split():
                yield doc, place, b" ".join(line.lower().split())


def linked_pairs(forms, at_least=80):
    """All pairs of different forms of more than one shingle that are similar enough."""
    shingles = {form: {form[k : k + 8] for k in range(len(form) - 7)} for form in set(forms) if len(form) > 8}
    by_shingle = defaultdict(list)
    for form in sorted(shingles):
        for other, both in Counter(o for s in shingles[form] for o in by_shingle[s]).items():
            if 100 * both >= at_least * (len(shingles[form]) + len(shingles[other]) - both):
                yield form, other
        for s in shingles[form]:
            by_shingle[s].append(form)


def texts_of(sf):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '/root/testdata/{sf}/documents.parquet'").fetchall()
    return dict(rows)


def test_every_line_equals_brute_force(spark):
    texts = texts_of("sf0.001")
    lines = list(forms_of(texts))
    parent = {form: form for _, _, form in lines}

    def root(form):
        while parent[form] != form:
            form = parent[form]
        return form

    for a, b in linked_pairs(form for _, _, form in lines):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    seen, dropped = set(), defaultdict(set)
    for doc, place, form in lines:
        if root(form) in seen:
            dropped[doc].add(place)
        seen.add(root(form))
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for row in line_dedup.dedup_lines(df, every=True).collect():
        own = (texts[row.doc_id] or "").split("\n")
        assert row.text == "\n".join(line for k, line in enumerate(own) if k not in dropped[row.doc_id])
        assert (row.n_lines, row.n_dropped) == (len(own), len(dropped[row.doc_id]))


def test_linked_pairs_share_a_band():
    """Measured on the lines of a thousand documents: at least 99 in 100; expected are 9,990 in 10,000 and more."""
    forms = sorted({form for _, _, form in forms_of(texts_of("sf0.01")) if len(form) > 8})
    pairs = list(linked_pairs(forms))
    lines = line_dedup.Lines(pa.array([form.decode() for form in forms]), every=True)
    keys = line_dedup._band_keys(line_dedup._minima(lines, np.arange(len(forms))))
    place = {form: i for i, form in enumerate(forms)}
    found = sum(bool((keys[place[a]] == keys[place[b]]).any()) for a, b in pairs)
    assert len(pairs) > 150 and found >= 0.99 * len(pairs)
