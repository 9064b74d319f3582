"""Every registered query of the library against its SQL in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

from tagloom.plans.demo import ORACLE_SQL, QUERIES

DATA = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return value.isoformat()[:19] if hasattr(value, "isoformat") else value


@pytest.mark.skipif(not DATA.exists(), reason="no tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    frame = QUERIES[name](spark, str(DATA))
    got = frame.collect()
    if name not in ORACLE_SQL:
        return
    result = duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(frame.columns)
    want = sorted((tuple(map(plain, r)) for r in result.fetchall()), key=repr)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got), key=repr) == want
