"""Every registered query with SQL gives DuckDB's rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from syncloom.plans.registry import queries, sql

SQL = sql()


def _text(v):
    if v is None:
        return "\0"
    return repr(round(v, 6)) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    from tests.conftest import SF

    c = duckdb.connect()
    c.execute("set TimeZone = 'UTC'")
    for f in Path(SF).glob("*.parquet"):
        c.execute(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, sf, duck, name):
    found = queries()[name](spark, sf)
    columns = sorted(found.columns)
    other = duck.sql(SQL[name])
    assert sorted(other.columns) == columns
    at = [other.columns.index(c) for c in columns]
    mine = sorted(tuple(map(_text, r)) for r in found.select(*[f"`{c}`" for c in columns]).collect())
    assert mine == sorted(tuple(_text(r[i]) for i in at) for r in other.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries()) - set(SQL)))
def test_rows_only(spark, sf, name):
    assert queries()[name](spark, sf).count() >= 1
