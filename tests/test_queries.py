"""Every registered query runs, and gives what its SQL gives, on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():  # noqa: ANN201
    c = duckdb.connect()
    for p in Path(FOLDER).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v: object) -> str:
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    return format(v, ".9g") if isinstance(v, float) else str(v)


def table(columns: list[str], data: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    if name in entry.oracle_sql():
        cursor = sql.execute(entry.oracle_sql()[name])
        columns = [c[0] for c in cursor.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == table(columns, cursor.fetchall())


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
