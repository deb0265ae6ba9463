"""Every registered query with SQL gives the rows of its SQL."""

import datetime
import decimal
import math

import duckdb
import pytest

from braidlake.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


def plain(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def rows_of(records, columns):
    return sorted((tuple(plain(r[c]) for c in columns) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    found = duck.execute(catalog.ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.collect(), sorted(names)) == rows_of([dict(zip(names, r, strict=True)) for r in found.fetchall()], sorted(names))


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_others_run(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0
