"""Driver contract: every query has an oracle and runs on the smallest data."""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as E

_spec = importlib.util.spec_from_file_location(
    "check_oracle", os.path.join(os.path.dirname(os.path.dirname(__file__)), "scripts", "check_oracle.py"))
check_oracle = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check_oracle)

FAST_KEYS = ["daily_generation_by_unit", "county_top_source", "generation_360_view", "plant_id_explode",
             "capacity_as_of", "missing_settlement_dates", "city_reference"]


def test_every_query_has_an_oracle():
    from wattframe import catalog

    assert set(catalog.queries()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(catalog.queries()) >= 38


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["county", "source_category", "total_daily_generation_mwh"]
    assert df.count() > 0


@pytest.mark.parametrize("key", FAST_KEYS)
def test_matches_oracle_at_smallest_scale(spark, sf_small, key):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    got = E.queries()[key](spark, sf_small).toPandas()
    exp = con.execute(E.oracle_sql()[key]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert check_oracle._rows(got) == check_oracle._rows(exp)
