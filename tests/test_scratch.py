"""Scopes share equal tables and leave no folder behind."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagloom.operators import cosine as C
from tagloom.plans.demo import QUERIES
from tagloom.sources import scratch

DATA = "/root/testdata/sf0.001"


def folders(spark):
    base = scratch.shared_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(base) if f.startswith("tagloom-")} if os.path.isdir(base) else set()


def test_equal_plans_share_a_table(spark):
    before = folders(spark)
    with scratch.scope(spark) as job:
        rows = lambda n: spark.range(10).where(F.col("id") > n)
        first, again, other = (scratch.written(rows(n), "t") for n in (3, 3, 4))
        assert first is again
        assert (first.count(), other.count()) == (6, 5)
        with scratch.scope(spark) as inner:
            assert inner is job
        assert len(job.tables) == 2
    assert folders(spark) == before


@pytest.mark.skipif(not Path(DATA).exists(), reason="no tables")
@pytest.mark.parametrize("name", ["m_merge", "m_interest", "m_itemcoll"])
def test_no_folder_is_left_after_a_query(spark, name):
    before = folders(spark)
    with scratch.scope(spark):
        assert QUERIES[name](spark, DATA).count() > 0
        assert len(folders(spark)) > len(before)
    assert folders(spark) == before


def test_folders_go_after_an_error(spark):
    before = folders(spark)
    with pytest.raises(ZeroDivisionError), scratch.scope(spark):
        scratch.written(spark.range(3), "t")
        raise ZeroDivisionError
    assert folders(spark) == before


def test_loose_tables_are_cleaned(spark):
    scratch.clean(spark)
    before = folders(spark)
    left = spark.createDataFrame([(1, "x", 1.0)], "item long, idx string, val double")
    assert C.cosine_pairs(left, left.withColumnRenamed("item", "other")).count() == 1
    assert len(folders(spark)) > len(before)
    scratch.clean(spark)
    assert folders(spark) == before
