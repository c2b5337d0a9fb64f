import pickle

import numpy as np
import pandas as pd

from souk.llm import toxicity
from souk.llm.common import held_out
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_edge_cases(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    learn = labels.where(~held_out(F.col("doc_id")))
    scorer = toxicity.train(toxicity.training_sample(docs, learn))
    test = docs.join(labels.where(held_out(F.col("doc_id"))), "doc_id")
    got = toxicity.score_texts(test, scorer).select("toxic", "score").toPandas()
    found, wrong = got[got.toxic == 1].score >= 0.7, got[got.toxic == 0].score >= 0.7
    assert found.mean() > 0.55 and wrong.mean() < 0.02
    assert got.score.between(0, 1).all()
    odd = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "idiot " * 40_000, 0.5), (3, "idiot " * 40_000, 0.5)],
                                "doc_id long, text string, score double")
    scores = [r.score for r in toxicity.score_texts(odd, scorer).orderBy("doc_id").collect()]
    assert scores[0] == scores[1] < 0.7 and scores[2] == scores[3] and all(0 <= s <= 1 for s in scores)
    assert (pickle.loads(pickle.dumps(scorer)).score(["the"]) == scorer.score(["the"])).all()


def test_windows_cover_the_whole_text():
    for text in (b"", b"a", b"word " * 100, b"x" * 500, b"\xc3\xa9 " * 90):
        parts = toxicity.windows(text)
        assert b"".join(parts) == text and all(len(p) <= 2 * toxicity.WINDOW for p in parts)


def test_without_labels_every_score_is_zero(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    scorer = toxicity.train(toxicity.training_sample(docs, labels))
    assert [r.score for r in toxicity.score_texts(docs, scorer).collect()] == [0.0, 0.0]
    assert toxicity.score_texts(docs.limit(0), scorer).count() == 0
    assert isinstance(scorer.score([None]), type(pd.Series([0.0]).to_numpy()))


def test_toxic_words_of_mislabelled_rows_and_of_rare_kinds_stay_known():
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklm"), 6)) for _ in range(400)]
    plain = lambda: " ".join(rng.choice(words, 60))
    insults = ["qrstuvw", "xyzzyqt", "wuvvtsr"]
    toxic = lambda k: f"{plain()} {insults[k % 3]} {plain()} {insults[(k + 1) % 3]}"
    rare = lambda: f"{plain()} zpozqor {plain()} zpozqor"         # 1 % of the toxic rows
    labelled = [(plain(), 0) for _ in range(1_500)] + [(toxic(k), 1) for k in range(600)]
    labelled += [(toxic(k), 0) for k in range(15)]                # label noise: every insult in ordinary rows
    labelled = [labelled[i] for i in rng.permutation(len(labelled))]
    ones = [i for i, x in enumerate(labelled) if x[1] == 1]
    for i in ones[:400:50]:
        labelled[i] = (rare(), 1)
    scorer = toxicity.train(labelled)
    assert all(w.encode() in scorer.toxic for w in (*insults, "zpozqor"))
    found, wrong = scorer.score([toxic(k) for k in range(60)]) >= 0.7, scorer.score([plain() for _ in range(60)]) >= 0.7
    assert found.mean() > 0.9 and wrong.mean() < 0.05


def test_training_texts_are_spread_over_long_texts(spark):
    text = " ".join(f"w{i}" for i in range(20_000))
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    got = dict((y, t) for t, y in toxicity.training_sample(docs, labels))
    assert got[0] == "short" and len(got[1]) <= toxicity.SAMPLE_CHARS + toxicity.SAMPLE_PIECES
    assert got[1].startswith("w0 ") and got[1].endswith(" w19999")
    assert {int(w[1:]) // 2_500 for w in got[1].split() if w[1:]} == set(range(8))
