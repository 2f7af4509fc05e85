"""Every query against its DuckDB text on the smallest tables."""

import datetime
import decimal
import os

import duckdb
import numpy as np
import pytest

from tidemark.plans import registry

registry.load()
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or isinstance(value, (bool, np.bool_)):
        return value
    if isinstance(value, (float, decimal.Decimal, np.floating)):
        return None if value != value else round(float(value), 9)
    if isinstance(value, (int, np.integer)):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()[:10] if not isinstance(value, datetime.datetime) else value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return str(value)


def rows_of(rows, columns):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{os.path.join(data, name)}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_oracle(spark, data, duck, name):
    frame = registry.QUERIES[name](spark, data)
    answer = duck.execute(registry.ORACLE_SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of([tuple(r) for r in frame.collect()], frame.columns) == rows_of(answer.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_oracle_runs(spark, data, name):
    assert registry.QUERIES[name](spark, data).count() > 0
