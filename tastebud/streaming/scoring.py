"""Score target pairs that arrive as files, with the batch CF plan per micro-batch.

Targets land as CSV files in a folder; a file-source stream picks them up and
``foreachBatch`` runs the same CF plan as the batch path on each micro-batch
against a fixed training table, whose deduplicated form and means are
prepared once before the stream starts.  Output goes to one folder per batch id,
written with overwrite, so a replayed batch (after a failure) replaces its own
output instead of duplicating it.  Progress lives in ``checkpoint``, which
must be on shared storage on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import similarity as S
from ..operators import cf as CF
from ..sources import schemas


def target_stream(spark: SparkSession, folder: str, max_files: int = 64) -> DataFrame:
    return (spark.readStream.schema(schemas.TARGET).option("header", True)
            .option("maxFilesPerTrigger", max_files).csv(folder))


def _batch_dirs(spark: SparkSession, root: str) -> dict[int, str]:
    """``batch=<id>`` sub-folders of ``root`` on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return {}
    out = {}
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("batch=") and fs.exists(
                jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out[int(name.split("=", 1)[1])] = st.getPath().toString()
    return out


def score_targets(spark: SparkSession, train: DataFrame, target_folder: str, out_folder: str,
                  checkpoint: str, n: int = S.TOP_N, available_now: bool = True,
                  max_files: int = 64, weight_memo: str | None = None):
    """Start the stream; returns the ``StreamingQuery``.

    ``train`` is (user_id, item_id, stars) with the same id types as the
    target files (strings for CSV input).  With ``weight_memo`` (a shared
    folder) pair weights are remembered across micro-batches: each batch
    scores only pairs that no earlier batch scored and stores those under
    ``batch=<id>``; it reads only folders of smaller ids, so a replayed batch
    recomputes exactly the same set.
    """
    prepared = CF.prepare(train)          # train-side tables once, not per batch

    def batch(df: DataFrame, epoch_id: int) -> None:
        targets = df.dropDuplicates(["user_id", "item_id"])
        known = None
        if weight_memo:
            earlier = [p for k, p in sorted(_batch_dirs(spark, weight_memo).items()) if k < epoch_id]
            if earlier:
                known = spark.read.parquet(*earlier)
        parts = CF.cf_parts(None, targets, n, prepared=prepared, known_weights=known)
        if weight_memo:     # written first, then read by the predictions: the batch's pairs are scored once
            scored = f"{weight_memo.rstrip('/')}/batch={epoch_id}"
            parts.evaluated.write.mode("overwrite").parquet(scored)
            parts.evaluated = spark.read.parquet(scored)
        CF.predict(parts).write.mode("overwrite").parquet(f"{out_folder.rstrip('/')}/batch={epoch_id}")

    w = target_stream(spark, target_folder, max_files).writeStream.foreachBatch(batch)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
