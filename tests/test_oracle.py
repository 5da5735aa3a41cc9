"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

DATA = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, SQL = contract.queries(), contract.oracle_sql()
TYPES = {
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the generated tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def comparable(rows, order):
    def cell(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    result = duck.execute(SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert {n: TYPES[t] for n, t in df.dtypes} == {d[0]: str(d[1]) for d in result.description}
    got = comparable(df.collect(), [df.columns.index(c) for c in sorted(columns)])
    assert got == comparable(result.fetchall(), [columns.index(c) for c in sorted(columns)])


def test_entry(spark):
    assert contract.entry(spark).count() > 0
