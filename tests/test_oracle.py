"""Every registered query against its DuckDB oracle on sf0.001."""

import os

import pytest

import __spark_entry__ as E

sys_path_tools = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools")

from conftest import SF_SMALL  # noqa: E402

from tickweave.plans.registry import QUERIES  # noqa: E402

ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    import importlib.util

    spec = importlib.util.spec_from_file_location("oracle_check", os.path.join(sys_path_tools, "oracle_check.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["pair", "slot", "timestamp", "open", "high", "low", "close", "volume", "source"]


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE) and set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    con = duck.duck(SF_SMALL)
    ddf = con.execute(ORACLE[name]).df()
    assert sorted(sdf.columns) == sorted(ddf.columns)
    a, b = duck.normalise(sdf), duck.normalise(ddf)
    assert len(a) == len(b)
    assert (a == b).all(axis=None), f"{name}: values differ"
