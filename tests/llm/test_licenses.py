"""License scan: templates by brute force over all blocks, phrases, odd rows."""

import random

from souk.llm import licenses
from souk.llm.licenses import Template


def _docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def _brute(text, templates, containment=80):
    words = licenses.template_words(text or "")
    best = {}
    for t in templates:
        wanted = licenses.template_words(t.text)
        held, size = set(wanted), -(-len(wanted) // licenses.STEP) * licenses.STEP
        for b in range(0, len(words), size):
            n = len(held & set(words[b:b + 2 * size]))
            if 100 * n >= containment * len(held):
                best[t.label] = max(best.get(t.label, 0), n / len(held))
    return best


def test_blocks_equal_brute_force(spark):
    rng = random.Random(5)
    pool = [w for t in licenses.TEMPLATES for w in licenses.template_words(t.text)] + ["lorem", "ipsum"] * 40
    texts = []
    for _ in range(60):
        words = [rng.choice(pool) for _ in range(rng.randint(0, 80))]
        kept = [w for w in licenses.template_words(rng.choice(licenses.TEMPLATES).text) if rng.random() < 0.85]
        at = rng.randint(0, len(words))
        texts.append(" ".join(words[:at] + kept + words[at:]))
    result, blocks = licenses.scan(_docs(spark, texts))
    own = {}
    for r in blocks.collect():
        own.setdefault(r.doc_id, {})
        own[r.doc_id][r.label] = max(own[r.doc_id].get(r.label, 0), r.share)
    want = {i: b for i, t in enumerate(texts) if (b := _brute(t, licenses.TEMPLATES))}
    assert own == want and len(want) > 20
    for r in result.collect():
        base = set(filter(None, r.base_labels.split(",")))
        assert set(filter(None, r.labels.split(","))) == base | set(want.get(r.doc_id, {}))
        assert r.score == (1.0 if base else max(want.get(r.doc_id, {0: 0.0}).values()))


def test_phrases_and_odd_rows(spark):
    long = "x " * 50_000 + "the MIT\n License, general public-license"
    texts = [None, "", "MIT License mit license apache  license", long, "MIT licenses", "ÉMIT License", "license"]
    rows = {r.doc_id: r for r in licenses.scan(_docs(spark, texts).selectExpr("*", "1 AS words", "'r' AS row"))[0].collect()}
    assert [tuple(rows[i])[1:7] for i in (0, 1)] == [(0, 0, None, None, "", "")] * 2 and rows[0].score == 0
    assert tuple(rows[2])[1:6] == (6, 3, 0, 4, "apache,mit")
    assert tuple(rows[3])[1:6] == (50_006, 2, 50_001, 50_003, "gpl,mit")
    assert rows[4].n_base == 0 and rows[5].n_base == 0 and rows[6].n_base == 0


def test_repeated_rows_empty_table_own_templates(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (1, "alpha beta gamma"), (None, "alpha beta")], "doc_id long, text string")
    own = [Template("t", "alpha beta gamma delta"), Template("none", "...")]
    got = sorted(((r.doc_id or 0, r.labels, r.score) for r in licenses.scan(docs, own, [], 75)[0].collect()))
    assert got == [(0, "", 0.0), (1, "t", 0.75), (1, "t", 0.75)]
    assert licenses.scan(docs.limit(0))[0].count() == 0
    assert {r.labels for r in licenses.scan(docs, [], [])[0].collect()} == {""}


def test_several_plans_find_the_same(spark, monkeypatch):
    texts = [t.text for t in licenses.TEMPLATES] * 2
    whole = sorted(map(tuple, licenses.scan(_docs(spark, texts))[1].collect()))
    monkeypatch.setattr(licenses, "WORDS_PER_PLAN", 30)
    assert sorted(map(tuple, licenses.scan(_docs(spark, texts))[1].collect())) == whole
