"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

from souk.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans(ranked_search.UPPER, ranked_search.LOWER)


def _brute(docs, items, k=10):
    bags = [(d, Counter(TERM.findall((t or "").translate(LOW)))) for d, t in docs]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 10 + (90 * b.total() * n_docs) // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * b[t]) // (1000 * b[t] + 8 * m))
                    for t in set(TERM.findall((text or "").translate(LOW))) if t in b)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, i + 1, d, -s) for i, (s, _, _, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def _data(rng, n):
    words = [f"w{i}" for i in range(300)] + ["Éa", "ß9"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (None, docs[3][1]), (5, docs[5][1]), (n + 2, " ".join(words * 200)), (n + 3, "--- ,,")]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(12)]
    return docs, items + [(90, None), (91, ""), (0, "w0 W0 w1"), (None, "w5 nowhere"), (92, "nowhere")]


def test_equals_scoring_everything(spark):
    docs, items = _data(random.Random(2), 700)
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "0 AS n", "'x' AS terms")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 AS item", "'x' AS term")
    want = _brute(docs, items)
    for args in ({}, {"block_postings": 500}, {"vocab_bytes": 0, "block_postings": 3000, "batch_terms": 10}):
        got = sorted((tuple(r) for r in ranked_search.top_documents(d, q, **args).collect()), key=str)
        assert got == want


def test_windows_are_skipped_and_ties_go_by_id(spark):
    texts = ["common filler"] * 400 + ["common rare"] * 12 + ["common filler other"] * 400
    docs = list(enumerate(texts))
    items = [(1, "common rare filler")]
    got = [tuple(r) for r in ranked_search.top_documents(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()]
    assert sorted(got, key=str) == _brute(docs, items) and sorted(r[2] for r in got) == list(range(400, 410))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked_search.top_documents(docs.limit(0), items).count() == 0
    assert ranked_search.top_documents(docs, items.limit(0)).count() == 0
    assert ranked_search.top_documents(docs, items).count() == 1
