"""Helpers shared by the training-data operators.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``; only A-Z is
lower-cased.  Both match what ``bytes.lower`` and ``bytes.split`` do, so Python
workers take the text as UTF-8 bytes; SQL code uses ``WORD`` and ``lower_az``.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastebud import session
from tastebud.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: distinct words remembered by one Python worker before its memo is emptied
MEMO_WORDS = 250_000

__all__ = ["WORD", "WordHashes", "connected_components", "held_out", "lower_az", "mix64", "materialize",
           "rolling", "ship_package", "table", "words_of"]


#: rows sent to a Python worker at once, unless the launch configuration sets it: whole texts are long
BATCH_ROWS = "1000"


def ship_package(spark: SparkSession) -> None:
    """Make the package importable on Python workers, and keep their batches of texts small."""
    session.ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if key not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(key, BATCH_ROWS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id as text leaves ``fold``; a null id counts as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % F.lit(folds), F.lit(0)) == F.lit(fold)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


class WordHashes(dict):
    """64-bit word hashes, remembered for up to ``MEMO_WORDS`` distinct words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of wrapped sums over the whole word (xor-shift and multiply)."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash per window of ``width`` words; fewer words give one window of them all."""
    n = len(hashes)
    if not n:
        return hashes
    span = min(n, width)
    total = np.full(n - span + 1, 0x9E3779B97F4A7C15 * span & (2**64 - 1), np.uint64)
    factor = 0xC2B2AE3D27D4EB4F
    for k in range(span):
        total += hashes[k : n - span + 1 + k] * np.uint64(factor)
        factor = factor * 0x9FB21C651E98DF25 & (2**64 - 1)
    return mix64(total)


def connected_components(links: DataFrame, name: str = "cc") -> DataFrame:
    """(node, comp) for every end of ``links`` (a, b); comp is the smallest node reachable.

    Large-star and small-star steps in turn: every node hands its larger (then
    its smaller) neighbours to the smallest neighbour.  The number of edges
    never grows and a few rounds suffice; each round is written to the shared
    folder, so nothing is gathered anywhere and a lost executor re-reads files.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct(), f"{name}_edges")
    state = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), f"{name}_round")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.countDistinct("u")).first()
        if tuple(now) == state or now[0] == 0:
            break
        state = tuple(now)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))).distinct()
