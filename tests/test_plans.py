"""Every query of the library against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from acreframe.plans.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or isinstance(v, str):
        return v
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    return str(v)


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), 0 if x is None else x) for x in r))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = in_order(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name not in ORACLE:
        assert rows
        return
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert rows == in_order(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
