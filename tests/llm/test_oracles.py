"""Queries with SQL give what DuckDB gives for that SQL, names of columns included."""

import duckdb
import pytest

from tidewell.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(spark, name, folder):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    ours = QUERIES[name](spark, folder)
    theirs = con.sql(ORACLE[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    rows = sorted(tuple(r) for r in ours.select(theirs.columns).collect())
    assert len(rows) and rows == sorted(theirs.fetchall())
