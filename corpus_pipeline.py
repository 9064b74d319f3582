"""From raw documents to shards: rules, near duplicates, benchmark leaks, mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; each result is
written as Parquet and read again as the next stage's documents. No stage fails on nulls,
repeated rows, very long texts, further columns of any name or an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm.common import materialise, scratch_path
from tagloom.llm.decontaminate import drop_leaks
from tagloom.llm.mixing import mix_documents
from tagloom.llm.ngram_join import drop_near_duplicates
from tagloom.llm.quality_rules import keep_quality
from tagloom.llm.sharding import ShardStore


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules; rejected ones go.

    Null and empty texts fail the base rule and go; equal rows all stay or go.
    """
    return keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates.

    Texts without a word stay; of rows that repeat one stays; a null doc_id comes last.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts stay; items of fewer than five words drop nothing; without a
    benchmark all documents stay.
    """
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of documents, drawn to the sources' target weights.

    Texts without a word give no row; a null source is one source; rows that repeat
    each give their own spans.
    """
    return mix_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed rows with the shard that holds each after compaction.

    Rows are kept as they come; without rows there is a version without shards.
    """
    store = ShardStore(spark, scratch_path(spark, "corpus"))
    store.append(docs)
    store.compact_all()
    store.expire()
    return store.read()


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: None: DuckDB has neither the hashes that the mix draws with nor files to shard.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
