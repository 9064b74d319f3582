"""Queries against their SQL on rows that only larger tables have."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from tagloom.plans.demo import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables")


def compare(spark, folder, name, **tables):
    """The query's rows and its SQL's, both sorted, with ``tables`` in place of those of the same name."""
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in DATA.glob("*.parquet"):
        if path.stem in tables:
            tables[path.stem].coalesce(1).write.parquet(f"{folder}/{path.name}")
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{folder}/{path.name}/*.parquet'")
        else:
            (Path(folder) / path.name).symlink_to(path)
            con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    frame = QUERIES[name](spark, str(folder))
    result = con.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    want = sorted(result.fetchall(), key=repr)
    return sorted((tuple(r[c] for c in columns) for r in frame.collect()), key=repr), want


def test_stored_headers_stay_beyond_a_million_items(spark, tmp_path):
    part = spark.read.parquet(f"{DATA}/part.parquet").withColumn("p_partkey", F.col("p_partkey") + 1_000_000)
    got, want = compare(spark, tmp_path, "k_kvcontrol", part=part)
    assert got == want
    assert ("b_c_1000003", 0, "999999#1") in got


def test_titles_that_end_in_a_cut_hash(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<title>token ec111b2d</title>"), (2, "u", "<title>Key A73D12</title>"), (3, "u", "<title>season 2 of 9\n</title>")], "page_id long, url string, html string")
    got, want = compare(spark, tmp_path, "m_vocab", pages=pages)
    assert got == want
    assert ("tokenec111b2d",) in got and ("keya73d",) in got
