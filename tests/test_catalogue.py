"""Every registered query against its SQL, in DuckDB over the same files."""

from __future__ import annotations

import math

import duckdb
import pytest

from folioforge.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in catalogue.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    return round(v, 6) if isinstance(v, float) and math.isfinite(v) else v


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query_equals_its_sql(spark, db, name):
    df = catalogue.queries()[name](spark, SF)
    r = db.execute(catalogue.oracle_sql()[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == sorted(df.columns)
    expected = sorted(repr(tuple(plain(v) for v in row)) for row in r.fetchall())
    assert sorted(repr(tuple(plain(row[c]) for c in names)) for row in df.collect()) == expected


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


def test_filters_and_columns_reach_the_scan(spark):
    plan = catalogue.queries()['allow_list_semi'](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(c_mktsegment,BUILDING)" in plan and "o_totalprice" not in plan


def test_entry_needs_no_training_data_operators():
    import __spark_entry__ as entry

    assert catalogue.FLAGSHIP in entry.queries() and set(entry.oracle_sql()) <= set(entry.queries())
