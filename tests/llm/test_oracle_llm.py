"""Queries of the training-data operators that SQL can state, against DuckDB on sf0.001."""

from __future__ import annotations

import os
import sys

import pytest

from conftest import ROOT, SF001
from tastebud.llm.queries import ORACLE_SQL, QUERIES

sys.path.insert(0, os.path.join(ROOT, "tools"))

import oracle_check  # noqa: E402


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    ok, rows, _, _, said = oracle_check.compare(spark, oracle_check.duck(SF001), SF001, key, QUERIES[key], ORACLE_SQL[key])
    assert ok and rows, said
