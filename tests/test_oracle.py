"""Every catalogue query against its DuckDB twin (multiset of rows, names)."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))
from oracle_check import TABLES, rows_of  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

NAMES = sorted(n for n in entry.oracle_sql() if n[0] in "qs" and n[1:3].isdigit())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def _check(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == {n: str(t) for n, t in zip(rel.columns, rel.types)}
    assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(rel.fetchall(), rel.columns)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    _check(spark, duck, name)


@pytest.mark.parametrize("name", [n for n in NAMES if n[:3] in {"q06", "q09", "q11", "q12", "q14", "q16", "q27"}])
def test_query_matches_oracle_with_hot_key_chunks(spark, duck, small_chunks, name):
    _check(spark, duck, name)


def test_every_query_has_an_oracle():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    own = {n for n in qs if n[0] in "qs" and n[1:3].isdigit()}  # the llm folder's queries have their own tests
    assert own <= set(sqls)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "account_no" in df.columns
