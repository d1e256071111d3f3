"""Every registered query with SQL against the comparing engine, over the smallest tables."""

import math

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return "[" + ",".join(map(normal, value)) + "]" if isinstance(value, list | tuple) else str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = entry.queries()[name](spark, SF)
    want = con.execute(entry.oracle_sql()[name])
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows([c[0] for c in want.description], want.fetchall())
