import corpus_pipeline
import __spark_entry__
from souk.llm import decontam, ngram_join, queries

SF = "/root/testdata/sf0.001"


def test_every_dealt_query_and_the_pipeline_are_registered():
    names = list(__spark_entry__.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "mixing", "sharding"]
    assert len(queries.QUERIES) == 13


def test_stages_decide_on_what_their_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        path = corpus_pipeline.saved(stage(spark, kept, SF), f"test-{name}")
        before, kept = kept, path
        if name != "sharding":
            assert kept.columns == columns
        if name in ("toxicity", "ngram_join", "decontamination"):
            assert 0 < kept.count() <= before.count()
            assert kept.exceptAll(before).isEmpty()
        if name == "ngram_join":
            groups = ngram_join.near_duplicates(before).collect()
            assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in groups if r.component_id == r.doc_id}
        if name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert not any(i in r.text for r in kept.collect() for i in items)
            found = decontam.contaminated(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert before.count() - kept.count() == found.select("doc_id").distinct().count()
        if name == "mixing":
            assert {r.doc_id for r in kept.collect()} <= {r.doc_id for r in before.collect()}
    assert kept.columns == [*columns, "shard", "slot"] and kept.count() == before.count()


def test_empty_and_odd_rows_pass(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, None, "en", None, 0), (3, "a b c", None, "s", 5)]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, slot string")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            frame = stage(spark, frame, SF)
        frame.collect()


def test_near_copies_and_contamination_are_decided_by_rows(spark):
    a, b = ("the first long text of many plain words in a row " * 2).strip(), ("some other passage with quite different words here " * 2).strip()
    rows = [(1, a), (2, b), (2, a), (1, a), (3, b + " more"), (None, a), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)
    kept = sorted(((r.doc_id, r.text) for r in corpus_pipeline.one_of_each_group(spark, docs, SF).collect()), key=str)
    assert kept == sorted([(1, a), (2, b), (4, None), (4, None)], key=str)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    mixed = spark.createDataFrame([(7, item, "en", "s", 1), (7, a, "en", "s", 1), (None, item, "en", "s", 1)], docs.schema).coalesce(1)
    assert [(r.doc_id, r.text) for r in corpus_pipeline.drop_contaminated(spark, mixed, SF).collect()] == [(7, a)]
