"""The stages one by one on a small corpus."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from costloom.llm import simhash, toxicity
from costloom.llm.common import prepare, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return table(spark, SF, "documents")


def test_stages_keep_the_columns(spark, docs):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_duplicates", "decontamination", "secrets", "packing"]
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_decisions_take_effect(spark, docs):
    toxic = {r["doc_id"] for r in toxicity.classify(docs, toxicity.learned(docs, table(spark, SF, "labels"))).filter("score >= 0.5").collect()}
    assert {r["doc_id"] for r in cp.without_toxic(spark, docs, SF).collect()} == {r["doc_id"] for r in docs.collect()} - toxic
    groups = simhash.digest(docs).collect()
    assert {r["doc_id"] for r in cp.without_copies(spark, docs, SF).collect()} == {r["component_id"] for r in groups}
    secret = docs.withColumn("text", F.concat("text", F.lit(" password=abcdef123")))
    for r in cp.without_secrets(spark, secret, SF).collect():
        assert "abcdef123" not in r["text"] and r["n_chars"] == len(r["text"])


def test_run_packs_what_is_left(spark, docs):
    rows = cp.run(spark, SF).collect()
    left = docs
    for _, stage in cp.STAGES[:-1]:
        left = stage(spark, left, SF)
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in left.collect()}


def test_odd_rows(spark, docs):
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b", "en", "s", 3), (None, None, None, None, None)], docs.schema)
    for _, stage in cp.STAGES:
        assert stage(spark, odd, SF).count() >= 2
        assert stage(spark, odd.filter("false"), SF).count() == 0


def test_rows_without_an_id_are_judged_too(spark, docs):
    passage = table(spark, SF, "benchmark").first()["text"]
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, passage), (3, passage), (3, text), (9, text), (None, text), (None, "own words stay"), (None, "own words stay")]
    odd = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    clean = cp.without_benchmark(spark, odd, SF).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in clean) == sorted((i or 0, t) for i, t in rows if t != passage)
    left = cp.without_copies(spark, odd, SF).collect()
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in left) == sorted([(3, passage), (3, text), (0, "own words stay")])
