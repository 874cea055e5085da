"""Text files as ordered lines: headers that may repeat, and positions over any number of files.

A file is read in splits (its blocks); a line belongs to one block, and a task
reads a block's lines in order.  The first line of a file is its header; every
line of that file that equals it is dropped, wherever it stands.  The files'
order is that of their paths.

**Position.**  The kept lines of each (file, block) are counted, the counts are
added up in file order (``running_sum``: range partitions, a running sum in
each, and one total a partition on the driver), and a line's position is the
sum before its block plus its place in it.  No window holds more than one
partition.

Empty lines are no rows.  A field that a line lacks is null.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import session as SE

#: headers travel by broadcast up to so many files; beyond, lines meet them in a shuffle
MOST_FILES = 100_000
BLOCK = ["file", "block"]
#: rows of one task where whole tables are sorted, beyond what the set number of partitions gives
TASK_ROWS = 500_000


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, block, value of every line that is not empty."""
    return (spark.read.text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
            .where(F.col("value") != ""))


def headers(lines: DataFrame) -> DataFrame:
    """(file, header): the first line of each file."""
    first = lines.where(F.col("block") == 0).withColumn("_at", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "_at").alias("header"))


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, block, at, value of the lines that do not equal their file's header; ``at`` orders a block's lines.

    Within a block ``at`` goes up by one a line.
    """
    lines = read_lines(spark, path)
    first = SE.materialize(headers(lines), "headers")
    kept = F.col("value") != F.col("header")
    if first.count() <= MOST_FILES:
        return (lines.join(F.broadcast(first), "file").where(kept)
                .select(*BLOCK, F.monotonically_increasing_id().alias("at"), "value"))
    lines = lines.withColumn("_at", F.monotonically_increasing_id())
    place = Window.partitionBy(*BLOCK).orderBy("_at")
    return (lines.join(first, "file").where(kept)
            .select(*BLOCK, F.row_number().over(place).cast("long").alias("at"), "value"))


def running_sum(df: DataFrame, order: list[str], n: str, out: str) -> DataFrame:
    """``df`` with the sum of ``n`` over all rows before each, in ``order`` (whose values are unique)."""
    ranged = SE.materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "running")
    totals = sorted(map(tuple, ranged.groupBy("_part").agg(F.sum(n)).collect()))       # a row a shuffle partition
    before = [(part, start) for (part, _), start in zip(totals, accumulate((t for _, t in totals), initial=0))]
    parts = df.sparkSession.createDataFrame(before, "_part int, _start long")
    inner = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(F.broadcast(parts), "_part")
            .withColumn(out, F.col("_start") + F.coalesce(F.sum(n).over(inner), F.lit(0))).drop("_part", "_start"))


def positioned(rows: DataFrame) -> DataFrame:
    """Rows of ``read_rows`` (and columns made of them) with ``position``, from 0, over all files."""
    rows = SE.materialize(rows, "lines")
    blocks = rows.groupBy(*BLOCK).agg(F.count("*").alias("_n"), F.min("at").alias("_first"))
    starts = SE.materialize(running_sum(blocks, BLOCK, "_n", "_before"), "blocks")      # a row a block
    return (rows.join(starts.drop("_n"), BLOCK)
            .withColumn("position", F.col("_before") + F.col("at") - F.col("_first")).drop("_before", "_first"))


def fields(count: int, value: str | Column = "value") -> list[Column]:
    """The first fields of a line cut at its commas."""
    cut = F.split(value, ",", -1)
    return [F.get(cut, F.lit(i)) for i in range(count)]


def split_at(rows: DataFrame, row: int) -> DataFrame:
    """``split``: train for the rows before position ``row``, val from there on."""
    return rows.withColumn("split", F.when(F.col("position") < row, "train").otherwise("val"))


def dealt(df: DataFrame, rows: int, *keys: str, by_range: bool = False) -> DataFrame:
    """``df`` dealt by ``keys`` in parts of about ``TASK_ROWS`` rows, where it has more than the set number of partitions would hold so."""
    tasks = -(-rows // TASK_ROWS)
    if tasks <= int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return df.repartitionByRange(*keys) if by_range else df
    return df.repartitionByRange(tasks, *keys) if by_range else df.repartition(tasks, *keys)


def zipped(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of two positioned tables side by side; they must have equally many."""
    n, m = left.count(), right.count()
    if n != m:
        raise ValueError(f"files of {n} and {m} rows cannot be zipped")
    clash = [c for c in (*BLOCK, "at", "value") if c in right.columns]
    return dealt(left, n, "position").join(dealt(right.drop(*clash), n, "position"), "position")
