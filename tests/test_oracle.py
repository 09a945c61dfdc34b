"""Every registered query against its SQL, over whole tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _rows(frame):
    columns = sorted(frame.columns)
    rows = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)
        for row in frame[columns].itertuples(index=False, name=None)
    ]
    return columns, sorted(rows, key=repr)


def _own():
    """Queries of this part of the library; those for training data have tests of their own."""
    return [n for n in sorted(contract.queries()) if not n.startswith("op") and n != "pipeline"]


def test_every_query_has_an_oracle():
    assert set(_own()) <= set(ORACLE)


@pytest.mark.parametrize("name", _own())
def test_query_equals_oracle(spark, duck, name):
    result = contract.queries()[name](spark, SF_DIR).toPandas()
    expected = duck.execute(ORACLE[name]).df()
    assert len(result) > 0
    assert _rows(result) == _rows(expected)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns[0] == "date"
    assert result.count() > 0
