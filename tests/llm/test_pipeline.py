"""The corpus pipeline, stage by stage, on the smallest tables."""

from pathlib import Path

import pytest

import corpus_pipeline
from tagloom.llm import decontaminate, ngram_join, quality_rules

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no tables")


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    kept = stages["quality_rules"](spark, docs, DATA).cache()
    assert kept.columns == columns
    assert kept.count() == quality_rules.with_quality(docs).where("quality.kept").count() < docs.count()
    single = stages["near_duplicates"](spark, kept, DATA).cache()
    assert single.columns == columns
    classes = ngram_join.ngram_jaccard_join(kept)
    assert {r["doc_id"] for r in single.collect()} == {r["class_id"] for r in classes.collect()}
    clean = stages["decontamination"](spark, single, DATA).cache()
    assert clean.columns == columns
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontaminate.find_leaks(clean, bench).count() == 0
    assert clean.count() == single.count() - decontaminate.find_leaks(single, bench).select("doc_id").distinct().count()
    mixed = stages["mixing"](spark, clean, DATA).cache()
    assert mixed.columns == columns
    texts = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(r["text"] in texts[r["doc_id"]] for r in mixed.collect())
    stored = stages["sharding"](spark, mixed, DATA)
    assert sorted(stored.select(*columns).collect()) == sorted(mixed.collect())


def test_run(spark):
    assert corpus_pipeline.run(spark, DATA).count() > 0


def test_stages_on_odd_rows(spark):
    """Nulls in any column, repeated rows, a long text and further columns go through all stages."""
    text = "the quick fox of the wood and its kin went to the river in the night for water that was cold and clear as glass"
    texts = [f"{text} number {i} of these" for i in range(12)] + [None, "", " \n", "and the word of it " * 30_000]
    rows = [(i if i % 5 else None, t, None if i % 4 == 0 else "en", None if i % 3 == 0 else "a", None, "x", None) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, lang string, source string, n_chars long, shard string, key string")
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, DATA)
        assert result.columns[: len(docs.columns)] == docs.columns
        if name != "sharding":
            docs = spark.createDataFrame(result.collect(), result.schema)
    assert result.count() == docs.count() > 0


def test_stages_on_no_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, DATA)
        assert result.collect() == []
        assert result.columns[: len(docs.columns)] == docs.columns
