"""Every registered telemetry query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import decimal
import os

import duckdb
import pytest

from wakeline.queries import ORACLE_SQL, QUERIES

from .conftest import SF


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(SF)):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(rows):
    value = lambda x: float(x) if isinstance(x, decimal.Decimal) else x
    return sorted((repr([value(x) for x in r]) for r in rows))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    names = sorted(got.columns)
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(want.columns) == names
    quoted = [f'"{n}"' for n in names]
    assert plain(map(tuple, got.select(*names).collect())) == plain(want.select(*quoted).fetchall())


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_nothing_imports_the_training_data_package():
    from .conftest import ROOT

    for f in (ROOT / "wakeline").rglob("*.py"):
        if "llm" not in f.parts:
            assert "wakeline.llm" not in f.read_text(), f
