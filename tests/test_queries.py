"""Every query against its SQL, run by another engine over the same tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

ENGINE = sorted(q for q in entry.oracle_sql() if not (q.startswith("op") and q[2:3].isdigit()) and q != "pipeline")


@pytest.fixture(scope="module")
def oracle(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda x: "null" if x is None or x != x else repr(float(x)) if isinstance(x, float) else str(x)
    return sorted(columns), sorted(tuple(value(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", ENGINE)
def test_query_equals_sql(spark, small, oracle, name):
    df = entry.queries()[name](spark, small)
    made = normal(df.columns, df.collect())
    oracle.execute(entry.oracle_sql()[name])
    expected = normal([c[0] for c in oracle.description], oracle.fetchall())
    assert made == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_of_the_engine_has_sql():
    assert {q for q in entry.queries() if q in ENGINE} == {q for q in entry.queries() if not q.startswith("op") and q != "pipeline"}
