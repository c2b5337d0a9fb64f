"""Spelling variants: near pairs against brute force, forms, roots, the vocabulary."""

import itertools
import random
import zlib

import numpy as np

from souk.llm import spelling


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _edit(rng, w, letters):
    i = rng.randrange(len(w) + 1)
    kind = rng.randrange(3)
    if kind == 0:
        return w[:i] + rng.choice(letters) + w[i:]
    i = min(i, len(w) - 1)
    return w[:i] + ("" if kind == 1 else rng.choice(letters)) + w[i + 1:]


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    for letters in ("ab", "abcé", "abcdefghijklmnopqrstuvwxyzàß"):
        words = {"".join(rng.choice(letters) for _ in range(rng.randint(4, 11))) for _ in range(150)}
        words |= {_edit(rng, w, letters) for w in list(words) for _ in range(3)}
        words = sorted(w for w in words | {"a" * 60, "a" * 61, "a" * 59 + "b"} if len(w) >= 4)
        vocab = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
        got = [(r.a, r.b) for r in spelling.near_words(vocab).collect()]
        want = {(a, b) for a, b in itertools.combinations(words, 2) if _near(a, b)}
        assert len(got) == len(set(got)) and set(got) == want and len(want) > 100


def test_pivots_are_disjoint_and_cheapest():
    rng = np.random.default_rng(1)
    places = np.sort(np.array([rng.choice(9, 4, replace=False) for _ in range(300)]), axis=1)
    places = places[(places[:, 3] - places[:, 0]) >= 2]
    cost = rng.integers(1, 50, places.shape)
    for p, c, got in zip(places, cost, spelling.choose_pivots(places, cost)):
        at = {x: y for x, y in zip(p, c)}
        pairs = [(a, b) for a, b in itertools.combinations(p, 2) if b - a >= 2]
        assert tuple(got) in [tuple(x) for x in pairs]
        assert at[got[0]] + at[got[1]] == min(at[a] + at[b] for a, b in pairs)


def test_forms_and_roots(spark):
    vocab = spark.createDataFrame(
        [("letters", 2000), ("lettersx", 100), ("letterxx", 100), ("lettxrxx", 3), ("littlexx", 5), ("lettxrxy", 30), ("alone", 4),
         ("pattern", 50), ("pattera", 50), ("patterz", 5), (None, 9), ("pattern", 1)], "word string, n long")
    rows = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variant_forms(vocab).collect()}
    assert rows["lettersx"] == ("letters", "letters", 100, 2, 2000)
    assert rows["lettxrxx"] == ("letterxx", "letterxx", 3, 2, 100)       # letterxx: no near word ten times as frequent
    assert rows["patterz"] == ("pattern", "pattern", 5, 2, 51) and rows["alone"] == (None, "alone", 4, 0, None)
    chain = spark.createDataFrame([("abcdefgh" + "z" * i, 10 ** i * 2) for i in range(7)], "word string, n long")
    got = {r.word: r for r in spelling.variant_forms(chain).collect()}
    assert {r.root for r in got.values()} == {"abcdefghzzzzzz"} and got["abcdefgh"].form == "abcdefghz"
    assert spelling.variant_forms(chain.limit(0)).count() == 0


def test_run_counts_equal_brute_force(spark):
    rng = random.Random(9)
    names = ["Commerce", "SÃO", "straße", "Ünïcödé", "naïveté×", "abcdefgh", "ABCDEFG", "commerçe", "ship-ment", "don't"]
    texts = [" ".join(rng.choices(names, k=200)) for _ in range(40)] + [None, "", "a" * 5000 + " " + "a" * 5000]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "Commerce Commerce"), (3, texts[3])], "doc_id long, text string")
    import re
    from collections import Counter
    want = Counter()
    for r in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            run = run.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            h = zlib.crc32(f"{'' if r.doc_id is None else r.doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    assert {r.word: r.n for r in spelling.run_counts(docs).collect()} == want
