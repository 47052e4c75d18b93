"""Ranked search against scoring every document, and on odd input."""

import math
import random
import re
from collections import Counter

import pytest

from broadsheet.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda c: c[0].lower(), term) for term in TERM.findall(text or "")]


def brute_force(docs, items, places=50):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, counts) for doc_id, counts in counted if counts]
    n_docs, n_terms = len(counted), sum(sum(counts.values()) for _, counts in counted)
    df = Counter(term for _, counts in counted for term in counts)
    asked: dict = {}
    for item_id, text in items:
        asked.setdefault(item_id, set()).update(terms(text))
    out = []
    for item_id, wanted in asked.items():
        scored = []
        for doc_id, counts in counted:
            m = 50 + (50 * sum(counts.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 20 * m))
                for t in wanted & counts.keys()
            )
            scored += [(-score, doc_id is None, doc_id)] if score > 0 else []
        out += [(item_id, rank, doc, -score) for rank, (score, _, doc) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:places], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, **options):
    documents = spark.createDataFrame([(*row, 1) for row in docs], "doc_id long, text string, rank int").repartition(3)
    asked = spark.createDataFrame([(*row, 2) for row in items], "item_id long, text string, score int")
    result = lexical.search(documents, asked, **options)
    assert result.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, result.collect()), key=str)


def corpus(seed, n_docs, n_items):
    """Topics of their own words, common words, copies and passages of items."""
    rng = random.Random(seed)
    common = [f"c{i}" for i in range(12)]
    topics = [[f"t{k}w{i}" for i in range(40)] for k in range(8)]
    text = lambda n: " ".join(rng.choice(common if rng.random() < 0.6 else rng.choice(topics)) for _ in range(n))
    items = [(i, text(rng.randrange(1, 30))) for i in range(n_items)]
    docs = [(i, text(rng.randrange(0, 80))) for i in range(n_docs)]
    for i in range(0, n_docs, 17):
        docs[i] = (i, f"{docs[i][1]} {rng.choice(items)[1]}")
    docs[5:40:3] = [(i, docs[5][1]) for i in range(5, 40, 3)]
    return docs, items


@pytest.mark.parametrize("shard, small, cells", [(4096, 32, 1 << 22), (64, 4, 200), (7, 1, 30)])
def test_equals_scoring_every_document(spark, monkeypatch, shard, small, cells):
    monkeypatch.setattr(lexical, "SHARD_DOCS", shard)
    monkeypatch.setattr(lexical, "SMALL_LIST", small)
    monkeypatch.setattr(lexical, "CELLS", cells)
    docs, items = corpus(3, 700, 12)
    assert found(spark, docs, items, places=10) == brute_force(docs, items, 10)


def test_blocks_of_items_and_small_shards(spark, monkeypatch):
    monkeypatch.setattr(lexical, "TERMS_A_BLOCK", 40)
    monkeypatch.setattr(lexical, "SHARD_POSTINGS", 100)
    docs, items = corpus(4, 200, 20)
    assert found(spark, docs, items) == brute_force(docs, items)


def test_blocks_are_skipped():
    """The bounds act: most documents are never scored."""
    import numpy as np

    rng = np.random.default_rng(1)
    n_terms, n_docs = 60, 3000
    rows = [np.unique(np.concatenate([rng.integers(0, 10, 6), 10 + (i % 10) * 5 + rng.integers(0, 5, 3)])) for i in range(n_docs)]
    starts = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
    weights = np.concatenate([np.full(10, 100), np.full(50, 5000)])
    flat = np.concatenate(rows)
    shard = lexical.Shard(list(range(n_docs)), starts, flat, weights[flat] * rng.integers(50, 100, len(flat)), n_terms)
    asked = np.array([0, 1, 2, 3, 10, 11, 12])
    queries = lexical.Queries(np.arange(n_terms, dtype=np.uint64), asked, np.array([0, len(asked)]))
    search = lexical.Search(queries, lexical.Corpus(n_docs, n_docs * 9, weights), 10)
    search.add(shard)
    assert search.scored < n_docs / 2
    scores = [int(shard.values[a:b][np.isin(flat[a:b], asked)].sum()) for a, b in zip(starts, starts[1:])]
    assert sorted(search.scores[0].tolist(), reverse=True) == sorted(scores, reverse=True)[:10]


def test_every_list_is_split_into_its_documents():
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(20, rng.integers(1, 8), replace=False)) for _ in range(400)]
    starts = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
    flat = np.concatenate(rows)
    shard = lexical.Shard(list(range(400)), starts, flat, rng.integers(1, 100, len(flat)), 20)
    for term in range(20):
        docs, begins = shard.blocks(term)
        assert sorted(docs.tolist()) == [i for i, row in enumerate(rows) if term in row]
        assert len(begins) > 1 and begins[0] == 0
        summary = shard.summaries(docs, begins, np.arange(20))
        for block, (low, high) in enumerate(zip(begins, [*begins[1:], len(docs)])):
            dense = np.zeros((high - low, 20), dtype=np.int64)
            for place, doc in enumerate(docs[low:high]):
                dense[place, rows[doc]] = shard.values[starts[doc] : starts[doc + 1]]
            assert (summary[block] == dense.max(axis=0)).all()


def test_odd_rows(spark):
    docs = [(1, "alpha Beta"), (1, "alpha beta"), (None, "ALPHA beta"), (2, None), (3, ""), (4, " -- "), (5, "Éa alpha " * 30_000)]
    items = [(1, "beta"), (1, "ALPHA beta beta"), (None, "éa Éa"), (2, None), (3, "?!"), (4, "nowhere")]
    assert found(spark, docs, items) == brute_force(docs, items)
    assert found(spark, [], items) == found(spark, docs, []) == found(spark, [(1, None)], items) == []


def test_ties_go_by_doc_id(spark):
    docs = [(i, "same words here") for i in range(200)] + [(900 + i, "other things") for i in range(300)]
    got = found(spark, docs, [(0, "same")])
    assert sorted(row[2] for row in got) == list(range(50))
