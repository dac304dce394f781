"""Every registered query against its check SQL on the whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF_CHECK
from fixtures.queries import QUERIES as REFERENCE

SQL = contract.oracle_sql()
QUERIES = contract.queries()
TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in Path(SF_CHECK).glob("*.parquet"):
        con.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    yield con
    con.close()


def ordered(rows, names):
    places = [names.index(name) for name in sorted(names)]
    return sorted((tuple(row[i] for i in places) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(name, spark, duck):
    expected = duck.execute(SQL[name])
    schema = {column[0]: TYPES[str(column[1])] for column in expected.description}
    names = [column[0] for column in expected.description]
    rows = expected.fetchall()
    df = QUERIES[name](spark, SF_CHECK)
    assert dict(df.dtypes) == schema
    assert ordered(map(tuple, df.collect()), df.columns) == ordered(rows, names)
    assert rows
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_only_the_fit_has_no_sql():
    assert set(REFERENCE) - set(SQL) == {"weekly_forecast", "weekly_forecast_literal"}
