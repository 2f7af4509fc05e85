"""The operators' queries that SQL can express, against that SQL on whole tables."""

import duckdb
import pytest

from tidemark.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    answer = con.execute(queries.ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    frame = queries.QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(map(tuple, frame.select(*columns).collect())) == sorted(answer.fetchall())
