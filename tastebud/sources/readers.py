"""File sources: rating/target CSVs, profile JSON lines, numeric matrices.

Readers never infer types and fail on malformed input.  Rating and target files
are read line by line (``lines``) and cut at commas: fields beyond the ones needed are
ignored, and an empty or lacking id is the empty string, not null.  The JSON schemas and options also parse lines that
come from a table (``parse_json``), as the CSV rules do (``parse_fields``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import lines, schemas

STRICT = {"mode": "FAILFAST"}
PLACE = [*lines.BLOCK, "at"]


def strict_double(c: Column) -> Column:
    """The number, null for null or empty; anything else stops the job."""
    number = c.try_cast("double")
    bad = F.raise_error(F.concat(F.lit("not a number: "), c)).cast("double")
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("double")).otherwise(F.coalesce(number, bad))


def parse_fields(fields: list[Column], names: list[str], number: str | None = None) -> list[Column]:
    """The first fields under their names: ids as strings, ``number`` as double."""
    return [(strict_double(c) if n == number else F.coalesce(c, F.lit(""))).alias(n) for c, n in zip(fields, names)]


def parse_json(lines: Column, schema: T.StructType) -> Column:
    return F.from_json(lines, schema, STRICT)


def read_ratings(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """Labelled rating lines: user_id, item_id, stars; every line that equals its file's first one is dropped."""
    raw = lines.read_rows(spark, path)
    cols = parse_fields(lines.fields(3), ["user_id", "item_id", "stars"], "stars")
    return raw.select(*cols, *(PLACE if place else []))


def read_targets(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """Target-pair lines, headers dropped alike; ``place`` adds file, block and at, which order all files' lines."""
    raw = lines.read_rows(spark, path)
    return raw.select(*parse_fields(lines.fields(2), ["user_id", "item_id"]), *(PLACE if place else []))


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Item profiles, one JSON object per line."""
    return (spark.read.schema(schemas.ITEM_JSON).options(**STRICT).json(path)
            .withColumnRenamed("business_id", "item_id"))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    """User profiles, one JSON object per line."""
    return spark.read.schema(schemas.USER_JSON).options(**STRICT).json(path)


def read_matrix(spark: SparkSession, path: str, columns: list[str],
                header: bool = True) -> DataFrame:
    """All-double numeric CSV (feature matrices written by other tools)."""
    schema = T.StructType([T.StructField(c, T.DoubleType(), True) for c in columns])
    return spark.read.schema(schema).options(**STRICT).option("header", header).csv(path)
