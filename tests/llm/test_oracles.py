"""Registered queries against their DuckDB SQL."""

import duckdb
import pytest

from tarmac.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "conversations", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    rows = sorted(tuple(r[c] for c in columns) for r in got.collect())
    cur = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == columns
    assert rows == sorted(tuple(r[names.index(c)] for c in columns) for r in cur.fetchall())
