"""The registered queries that SQL can state, against DuckDB on the smallest sample."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from holdfast.llm import catalog
from tests.conftest import SMALL


@pytest.mark.parametrize("key", list(catalog.ORACLES))
def test_query_matches_its_sql(spark, key):
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got, expected = catalog.QUERIES[key](spark, SMALL).toPandas(), connection.execute(catalog.ORACLES[key]).df()
    assert sorted(got.columns) == sorted(expected.columns)
    columns = sorted(got.columns)
    rows = lambda frame: sorted(map(str, frame[columns].itertuples(index=False, name=None)))
    assert rows(got) == rows(expected)


def test_all_operators_are_registered():
    assert {k.split("_")[0] for k in catalog.QUERIES} == {f"op{i}" for i in range(1, 14)}
