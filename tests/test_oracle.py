"""Every SQL-checkable catalog key against its DuckDB oracle on sf0.001."""

import os
import sys

import pytest

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import oracle_check  # noqa: E402
from tastebud.plans import catalog, oracle  # noqa: E402

KEYS = sorted(k for k in oracle.SQL if k in catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF001)


def test_every_sql_key_is_a_query():
    assert set(oracle.SQL) <= set(catalog.QUERIES)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    ok, n, _, _, msg = oracle_check.compare(spark, con, SF001, key, catalog.QUERIES[key],
                                            oracle.SQL[key])
    assert ok, f"{key}: {msg}"


def test_entry_contract(spark):
    sys.path.insert(0, ROOT)
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["user_id", "item_id", "prediction", "n_neighbours", "route"]
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
