"""Sinks: prediction files, feature tables, model parameters.

Prediction files keep the surveyed layout: a header line
``user_id, business_id, prediction`` then ``user,item,prediction`` lines,
unquoted, in target order.  The lines are built with ``concat_ws`` on the
executors; the writer never gathers rows on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed header text of a prediction file.
PREDICTION_HEADER = "user_id, business_id, prediction"


def _line():
    fields = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("user_id", "item_id", "prediction"))
    return F.concat_ws(",", *fields).alias("line")


def prediction_lines(pred: DataFrame) -> DataFrame:
    """One ``line`` column: user,item,prediction; a missing field is empty, never left out."""
    return pred.select(_line())


def write_predictions(pred: DataFrame, path: str, order_col: str | list[str] | None = None) -> None:
    """Write a prediction folder of text lines: one header, at the start of the first file.

    With ``order_col`` (one or several) the file order follows it (a range-partitioned sort, not
    a single-task sort); the header's nulls sort first.
    """
    order = [order_col] if isinstance(order_col, str) else order_col or []
    lines = pred.select(*order, _line())
    head = pred.sparkSession.range(1).select(
        *(F.lit(None).cast(pred.schema[c].dataType).alias(c) for c in order), F.lit(PREDICTION_HEADER).alias("line"))
    out = head.unionByName(lines)
    (out.orderBy(*order) if order else out).select("line").write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Feature / embedding sink: Parquet (columnar, splittable, typed)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_features_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """Headerless CSV of a feature table (the surveyed interchange format)."""
    df.write.mode("overwrite").option("header", header).csv(path)


def save_model(model, spark, path: str) -> None:
    """The trees as a table, one row a node."""
    model.table(spark).coalesce(1).write.mode("overwrite").parquet(path)


def load_model(spark, path: str):
    from ..operators.boost import Forest
    return Forest.read(spark.read.parquet(path))
