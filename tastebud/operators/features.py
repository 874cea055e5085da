"""Profile features: categories, vocabulary, sparse multi-hot, feature rows.

The multi-hot block is kept sparse: an item maps to its sorted category ids
(never an items x vocabulary product).  The three-valued semantics are kept
through ``n_categories``: null when the item has no profile or an empty /
null category string (every category unknown), else the number of distinct
categories (every other category is 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import session as SE
from ..sources.schemas import USER_FEATURES

# Fixed value: the separator of the category string.
CATEGORY_SEP = ", "

ITEM_RENAME = {"stars": "item_stars", "review_count": "item_review_count"}


def has_categories(col: str = "categories"):
    """Truthy category string: not null and not empty."""
    return F.col(col).isNotNull() & (F.col(col) != "")


def item_categories(items: DataFrame) -> DataFrame:
    """(item_id, category), one row per distinct category of each item."""
    return (items.where(has_categories())
            .select("item_id", F.explode(F.split("categories", CATEGORY_SEP)).alias("category"))
            .distinct())


def dense_index(df: DataFrame, key: str, out: str, name: str = "dense") -> DataFrame:
    """Attach a 0-based dense index in ``key`` order, without a global window.

    Range-partition and sort, record each row's (partition, position) from
    ``monotonically_increasing_id`` in the same stage, freeze that table, then
    add per-partition offsets computed from one count row per partition (a
    table bounded by the partition count, hence safe to broadcast).
    """
    mid = F.monotonically_increasing_id()
    ranged = (df.repartitionByRange(key).sortWithinPartitions(key)
              .withColumn("_mid", mid))
    ranged = SE.materialize(ranged.select(key, (F.col("_mid") / F.lit(1 << 33)).cast("long").alias("_p"),
                                          (F.col("_mid") % F.lit(1 << 33)).alias("_r")), name)
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)))
    return (ranged.join(F.broadcast(offsets.select("_p", "_off")), "_p")
            .select(key, (F.col("_off") + F.col("_r")).cast("int").alias(out)))


def category_vocab(items: DataFrame) -> DataFrame:
    """(category, category_id): distinct categories, ids 0.. in sorted order."""
    cats = item_categories(items).select("category").distinct()
    return dense_index(cats, "category", "category_id", "vocab")


def item_category_ids(items: DataFrame, vocab: DataFrame) -> DataFrame:
    """Sparse multi-hot per profiled item: (item_id, n_categories, ids).

    ``ids`` is the sorted array of category ids; both are null when the
    category string is null or empty.  Each item's list is bounded by its own
    category string, so the per-item collect is row-sized.
    """
    ic = item_categories(items).join(vocab, "category")
    per_item = ic.groupBy("item_id").agg(F.array_sort(F.collect_list("category_id")).alias("ids"))
    return (items.select("item_id").join(per_item, "item_id", "left")
            .select("item_id", F.size("ids").cast("bigint").alias("n_categories"), "ids")
            .withColumn("n_categories", F.when(F.col("ids").isNull(), F.lit(None).cast("bigint"))
                        .otherwise(F.col("n_categories"))))


def multi_hot_rows(rows: DataFrame, item_ids: DataFrame, fill: bool = False) -> DataFrame:
    """Per distinct item of ``rows``: n_categories and ids text (null-aware).

    ``fill`` turns unknown into an empty set (the null -> 0 step).
    """
    items = rows.select("item_id").distinct()
    j = items.join(item_ids, "item_id", "left")
    n = F.col("n_categories")
    ids_text = F.array_join(F.transform("ids", lambda x: x.cast("string")), ",")
    if fill:
        return j.select("item_id", F.coalesce(n, F.lit(0)).cast("bigint").alias("n_categories"),
                        F.coalesce(ids_text, F.lit("")).alias("category_ids"))
    return j.select("item_id", n.alias("n_categories"), ids_text.alias("category_ids"))


def user_dim(users: DataFrame) -> DataFrame:
    return users.select("user_id", *USER_FEATURES)


def item_dim(items: DataFrame) -> DataFrame:
    return items.select("item_id", F.col("stars").alias("item_stars"),
                        F.col("review_count").alias("item_review_count"), "is_open")


def feature_rows(rows: DataFrame, users: DataFrame, items: DataFrame,
                 item_ids: DataFrame | None = None) -> DataFrame:
    """Rating rows left-joined to the user and item profiles (J1, J2).

    Missing profiles give null features; ``n_categories`` follows the
    three-valued rule when ``item_ids`` is given.
    """
    out = (rows.join(user_dim(users), "user_id", "left")
           .join(item_dim(items), "item_id", "left"))
    if item_ids is not None:
        out = out.join(item_ids.select("item_id", "n_categories"), "item_id", "left")
    return out


def split_rank():
    return F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)


def first_occurrence(rows: DataFrame, key: str, position: str | None = None) -> DataFrame:
    """First row per ``key``: by ``position`` where given, else in (split, item/user, stars) order.

    A min of a struct: a partial aggregate (no window, no group gathered in one task).
    """
    other = "item_id" if key == "user_id" else "user_id"
    place = F.col(position) if position else split_rank()
    m = F.min(F.struct(place.alias("s"), F.col(other).alias("o"), F.col("stars").alias("r")))
    return (rows.groupBy(key).agg(m.alias("f"))
            .select(key, F.col("f.o").alias(f"first_{other}"), F.col("f.r").alias("first_stars")))
