"""Registered queries against DuckDB on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from placeweave.plans import registry

DATA = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return connection


def cells(frame: pd.DataFrame) -> list[str]:
    def plain(v):
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return None
        return round(float(v), 9) if isinstance(v, int | float) or hasattr(v, "dtype") else str(v)

    return sorted(repr([plain(v) for v in row]) for row in frame[sorted(frame.columns)].astype(object).values.tolist())


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_matches_sql(spark, oracle, name):
    got = registry.QUERIES[name](spark, str(DATA)).toPandas()
    want = oracle.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got) == cells(want)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, str(DATA)).count() > 0
