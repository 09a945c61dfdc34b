"""Queries of this part that have SQL, against it, over whole tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.01"
ORACLE = {n: q for n, q in contract.oracle_sql().items() if n.startswith("op")}


def plain(value):
    if pd.isna(value):
        return None
    if isinstance(value, float) and not math.isinf(value) and value == int(value):
        return int(value)
    return value


def rows(table):
    columns = sorted(table.columns)
    found = table[columns].itertuples(index=False, name=None)
    return columns, sorted((tuple(map(plain, row)) for row in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    expected = duck.execute(ORACLE[name]).df()
    assert rows(contract.queries()[name](spark, SF_DIR).toPandas()) == rows(expected)
