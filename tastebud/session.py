"""Session construction and shared-folder helpers.

The library never assumes a machine-local folder on a cluster: lineage cuts go
to ``spark.checkpoint.dir`` as configured by the cluster.  Only in local mode
(tests, benches) do we fall back to a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults of this package.  A key that the launch configuration has, and every
# key of a session that runs already, stays as it is.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app: str = "tastebud",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control on a
    cluster.  ``shuffle_partitions`` is the AQE upper bound; AQE coalesces
    small partitions at run time.
    """
    running = SparkSession.getActiveSession() is not None
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            b = b.config("spark.ui.enabled", "false")
    conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}
    for k, v in (conf | (extra or {})).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    if not running:
        launched = dict(spark.sparkContext.getConf().getAll())
        for k, v in DEFAULT_CONF.items():
            if k not in launched:
                spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only in local mode."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if sc.master.startswith("local"):
        d = tempfile.mkdtemp(prefix="tastebud-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/…) "
        "so lineage cuts survive executor loss")


MAX_RECORDS_KEY = "tastebud.materialize.maxRecordsPerFile"
DEFAULT_MAX_RECORDS = 1_000_000
_written: list[str] = []


def remove(spark: SparkSession, path: str) -> None:
    """Delete a table or checkpoint that this package wrote in the shared folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def released(spark: SparkSession):
    """Remove, at the end, every table that ``materialize`` writes inside.

    Results must have been written or read by then: their plans read those tables.
    """
    first = len(_written)
    try:
        yield
    finally:
        for path in _written[first:]:
            remove(spark, path)
        del _written[first:]


def folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder, removed by ``released``."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def materialize(df, name: str):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads files instead of
    recomputing the plan), lets several consumers share one computation even
    when column pruning makes their sub-plans differ, and gives AQE exact
    sizes for its join choices.
    """
    spark = df.sparkSession
    path = folder(spark, name)
    # bounded file size so readers get enough, even splits (a file with one
    # row group is one read task); no extra shuffle is added for this
    per_file = spark.conf.get(MAX_RECORDS_KEY, str(DEFAULT_MAX_RECORDS))
    df.write.mode("overwrite").option("maxRecordsPerFile", per_file).parquet(path)
    return spark.read.parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the Python workers (once per context).

    Code that runs in Python workers (``mapInPandas``) pickles module
    functions by reference, so the workers must import ``tastebud``.  With
    ``spark-submit --py-files`` it already is; otherwise the sources are
    zipped on the driver and added with ``SparkContext.addPyFile``, which
    Spark distributes to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_tastebud_shipped", False):
        return
    submitted = sc.getConf().get("spark.submit.pyFiles", "") or ""
    if any("tastebud" in os.path.basename(f) for f in submitted.split(",") if f):
        sc._tastebud_shipped = True       # already distributed by spark-submit
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="tastebud-pkg-"), "tastebud.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    p = os.path.join(d, f)
                    z.write(p, os.path.relpath(p, root))
    sc.addPyFile(out)
    sc._tastebud_shipped = True
