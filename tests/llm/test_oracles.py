"""Queries of this package against their SQL on the smallest tables."""

import duckdb
import pytest

from turnwise.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.sql(queries.ORACLE[name])
    columns = sorted(want.columns)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    rows = want.select(*[f'"{c}"' for c in columns]).fetchall()
    assert sorted(map(str, rows)) == sorted(str(tuple(r)) for r in got.select(*columns).collect())
