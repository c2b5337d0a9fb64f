import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import langid
from souk.llm.common import held_out

SF = "/root/testdata/sf0.01"


def test_posteriors_equal_plain_forward_backward(monkeypatch):
    rng = np.random.default_rng(0)
    tagger = langid.Tagger(["a", "b", "c"])
    tagger.moves = rng.normal(size=(3, 3))
    at = np.array([0, 1, 1, 40, 140, 150])
    scores = rng.normal(size=(150, 3)) * 2
    got, a = tagger.posteriors(scores, at), np.exp(tagger.moves)
    for x, y in zip(at[:-1], at[1:]):
        e = np.exp(scores[x:y])
        fwd, bwd = [e[0] / 3] if y > x else [], [np.ones(3)]
        for t in range(1, y - x):
            fwd.append(fwd[-1] @ a * e[t])
            fwd[-1] /= fwd[-1].sum()
            back = a @ (bwd[0] * e[y - x - t])
            bwd.insert(0, back / back.sum())
        if y > x:
            both = np.array(fwd) * np.array(bwd)
            assert np.allclose(got[x:y], both / both.sum(axis=1, keepdims=True))
    assert np.allclose(tagger._expected(scores, at[[0, 1, 3]])[0], got[:40])


@pytest.fixture(scope="module")
def tagger(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return langid.train(langid.training_texts(docs.where(~held_out(F.col("doc_id")))))


def test_held_out_accuracy(spark, tagger):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where(held_out(F.col("doc_id")))
    got = langid.with_language(docs, tagger).select("lang", "lang_pred", "score").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()


def test_edge_cases(spark, tagger):
    rows = [(1, None), (2, ""), (3, "12 ... %%"), (4, "of the and with " * 20_000), (4, "of the and with " * 20_000), (None, "of the and with")]
    df = spark.createDataFrame([(d, t, "x", 0.0) for d, t in rows], "doc_id long, text string, lang string, score double")
    got = langid.with_language(df.drop("score"), tagger).collect()
    assert sorted(r.lang_pred for r in got) == ["en"] * 3 + ["und"] * 3
    assert langid.with_language(df.limit(0).drop("score"), tagger).count() == 0
    assert {r.lang_pred for r in langid.with_language(df.drop("score"), None).collect()} == {"und"}
    assert langid.train([]) is None


def test_code_switched_text_has_runs(tagger):
    english, german = "with the thing that was of the and for them", "die und einer der nicht ist auf den sich mit"
    runs = tagger.runs(f"{english} {english} {german} {german}")
    assert [r[0] for r in runs if r[2] > 5] == ["en", "de"] and sum(r[2] for r in runs) == 40
