"""The plan report reads the final adaptive plan of the executed query."""

import os
import sys

from conftest import ROOT, SF001

sys.path.insert(0, os.path.join(ROOT, "tools"))

import plan_report  # noqa: E402
from tastebud.plans import catalog  # noqa: E402


def test_plan_report_on_cf(spark):
    out = plan_report.summarise(catalog.QUERIES["topn_neighbours"](spark, SF001))
    assert "WindowGroupLimit: 2" in out
    assert "scan struct<" in out
