"""Every query of the library against its SQL on the smallest tables: columns, rows and values."""

import math

import duckdb
import pytest

from siltstone import oracle, queries as library, stage_oracle, stage_queries

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = library.queries() | stage_queries.queries()
SQL = oracle.oracle_sql() | stage_oracle.oracle_sql()
#: Queries that may be empty on the smallest tables.
MAY_BE_EMPTY = {"md5_tokens"}


@pytest.fixture(scope="session")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def test_all_queries_have_sql():
    assert set(QUERIES) == set(SQL)
    assert not set(library.queries()) & set(stage_queries.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    cursor = con.execute(SQL[name])
    assert sorted(x[0] for x in cursor.description) == names
    want = con.execute(f"select {', '.join(names)} from ({SQL[name]})").fetchall()
    rows = ordered(got.select(*names).collect())
    assert rows == ordered(want)
    assert rows or name in MAY_BE_EMPTY
