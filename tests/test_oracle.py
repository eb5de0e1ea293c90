"""Every proof query against its SQL oracle on the smallest sample."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from proof import catalog
from tests.conftest import SMALL

ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (bool, str)) or type(value).__name__ in ("bool_",):
        return value if isinstance(value, str) else bool(value)
    return round(float(value), 6) + 0.0


def _rows(frame):
    columns = sorted(frame.columns)
    return columns, sorted(([_plain(v) for v in row] for row in frame[columns].itertuples(index=False, name=None)), key=str)


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_query_matches_oracle(spark, database, key):
    got = contract.queries()[key](spark, SMALL).toPandas()
    if key not in ORACLES:
        assert len(got) > 0
        return
    assert _rows(got) == _rows(database.execute(ORACLES[key]).df())


def test_entry_has_rows(spark):
    result = contract.entry(spark)
    assert result.count() > 0
    assert "priority_score" in result.columns
