"""Python-worker code must run when the caller's working directory is elsewhere."""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT

SCRIPT = r"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
s = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as E
df = E.queries()["category_embed"](s, "/root/testdata/sf0.001")
print("ROWS", df.count())
s.stop()
"""


def test_embedding_runs_from_another_cwd():
    cwd = tempfile.mkdtemp(prefix="tastebud-cwd-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    r = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], cwd=cwd, env=env,
                       capture_output=True, text=True, timeout=600)
    assert "ROWS" in r.stdout, r.stderr[-2000:]
    assert int(r.stdout.split("ROWS")[1].split()[0]) > 0
