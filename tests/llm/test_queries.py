"""Registered queries against their SQL on the small tables."""

import duckdb
import pytest

from lakeworks.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = QUERIES[name](spark, SF)
    cols = sorted(rows.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE[name]})").fetchall()
    assert sorted(map(tuple, rows.select(*cols).collect())) == sorted(want)
