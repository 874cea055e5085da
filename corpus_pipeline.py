"""Corpus pipeline: quality, near duplicates, benchmark leaks, secrets, mixture.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir)
and returns the documents that it keeps.  Each result is written as Parquet and
read again as the next stage's input.  All stages but the last return the
columns of ``documents``; the last adds the mixture's counts.

* quality: documents that the classifier scores below 0.5 go.  Its labels are
  those of the rows that op10 learns from.
* near_duplicates: of documents linked by 5-word shingles (Jaccard 0.8 or more) the
  one with the smallest id stays.
* decontamination: documents that hold a benchmark item, edited or not, go.
* secrets: every span is replaced by ``[SECRET]`` in ``text``; ``n_chars`` follows.
* mixture: documents that the mix takes at least once stay, with ``taken`` words;
  one without words too, where the mix takes its row (0 words).

Null, empty and very long texts pass every stage as its operator's text says;
a null id is carried.  Of repeated rows near_duplicates keeps one.  Columns of
``documents`` are kept, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastebud.llm import decontam, jaccard, mixing, quality, secrets
from tastebud.llm.common import held_out, materialize, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, table(spark, sf_dir, "labels"), held_out(docs["doc_id"], 3, 1))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redacted(docs, secrets.fitted(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs).filter("copies > 0").drop("copies")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_removal),
    ("mixture", mixture),
]

#: a fitted classifier and field decide rows; the tests compare run() with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
