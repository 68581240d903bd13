"""Every bound query against its SQL counterpart on the smallest test tables."""

import os
from glob import glob

import duckdb
import pytest

import __spark_entry__ as entry_file

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_file.queries(), entry_file.oracle_sql()
TYPES = {"BOOLEAN": "boolean", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_file.entry(spark).count() > 0


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    answer = duck.execute(ORACLES[name])
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in answer.description}
    assert dict(result.dtypes) == kinds
    places = [list(kinds).index(c) for c in columns]
    expected = sorted(repr([row[i] for i in places]) for row in answer.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in result.collect()) == expected


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(ORACLES) if not n.startswith(("op", "pipeline"))))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
