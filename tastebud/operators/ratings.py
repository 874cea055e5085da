"""Rating-table aggregates: dedup, means, histories, known keys, splits.

Every aggregate is a ``groupBy().agg()`` with partial (map-side) aggregation,
so a hot user or item is combined per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup(train: DataFrame, how: str = "max") -> DataFrame:
    """One stars value per (user, item).

    Conflicting ratings of a pair resolve deterministically: ``max`` (default),
    ``min`` or ``avg``.
    """
    agg = {"max": F.max, "min": F.min, "avg": F.avg}[how]
    return train.groupBy("user_id", "item_id").agg(agg("stars").alias("stars"))


def dedup_with_raw(train: DataFrame, how: str = "max") -> DataFrame:
    """Dedup plus the raw sum and row count of each (user, item).

    The user mean over raw rows (duplicates included) is then exact from this
    one table: sum(s_raw) / sum(n_raw) per user.
    """
    agg = {"max": F.max, "min": F.min, "avg": F.avg}[how]
    return (train.groupBy("user_id", "item_id")
            .agg(agg("stars").alias("stars"), F.sum("stars").alias("s_raw"),
                 F.count(F.lit(1)).alias("n_raw")))


def user_mean_from_dedup(r: DataFrame) -> DataFrame:
    """User mean over raw rows computed from ``dedup_with_raw`` output."""
    return (r.groupBy("user_id")
            .agg((F.sum("s_raw") / F.sum("n_raw")).alias("mean_stars"),
                 F.sum("n_raw").alias("n")))


def user_mean(train: DataFrame) -> DataFrame:
    """Mean over the raw rows (duplicates included) and row count per user."""
    return (train.groupBy("user_id")
            .agg(F.avg("stars").alias("mean_stars"), F.count(F.lit(1)).alias("n")))


def item_mean(dedup_train: DataFrame) -> DataFrame:
    """Mean and rater count per item over the deduplicated rows."""
    return (dedup_train.groupBy("item_id")
            .agg(F.avg("stars").alias("mean_stars"), F.count(F.lit(1)).alias("n")))


CHECKSUM_MOD = 1000003


def history(r: DataFrame, key: str, other: str) -> DataFrame:
    """Per ``key``: the set of distinct ``other`` ids, summarised.

    A set can be as large as the table (one user may hold a third of all
    rows), so it is never collected into one row; the set stays the rating
    table itself for the joins, and this report gives its size and an
    order-free fingerprint (min, max and a modular checksum of the ids), all partial
    aggregates.
    """
    d = r.select(key, other).distinct()
    o = F.col(other)
    # checksum terms are below 10^6, so the bigint sum cannot overflow for any
    # group under 9 * 10^12 ids
    term = F.pmod(o.cast("bigint"), F.lit(CHECKSUM_MOD))
    return (d.groupBy(F.col(key).alias("id"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(o).alias("min_id"),
                 F.max(o).alias("max_id"), F.sum(term).cast("bigint").alias("id_checksum")))


def members(r: DataFrame, key: str, other: str) -> DataFrame:
    """The set of ``other`` ids of each ``key``, one (id, member) row each, with the set's size.

    Sets stay rows: the size is a partial aggregate joined back, no array is built.
    """
    d = r.select(F.col(key).alias("id"), F.col(other).alias("member")).distinct()
    return d.join(d.groupBy("id").agg(F.count(F.lit(1)).alias("n")), "id")


def known_keys(r: DataFrame, key: str) -> DataFrame:
    """Distinct ids of ``key`` over train and val with membership flags."""
    return (r.where(F.col("split").isin("train", "val"))
            .groupBy(F.col(key).alias("id"))
            .agg(F.max((F.col("split") == "train").cast("int")).cast("boolean").alias("in_train"),
                 F.max((F.col("split") == "val").cast("int")).cast("boolean").alias("in_val")))


def split_counts(r: DataFrame) -> DataFrame:
    return r.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def train_val_union(r: DataFrame) -> DataFrame:
    """Bag union of train and val rows (duplicates kept)."""
    tr = r.where(F.col("split") == "train").select("user_id", "item_id", "stars")
    va = r.where(F.col("split") == "val").select("user_id", "item_id", "stars")
    return tr.unionByName(va)
