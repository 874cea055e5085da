"""Target-driven item-item similarity.

Only pairs that some target needs are scored: for a target (u, b) the
candidates are (b, b0) for every b0 rated by u (b0 = b included).

Co-ratings of the candidate pairs come from two kinds of users.  One with at
most ``LIGHT_ROWS`` ratings of items that are in pairs has them paired with each
other: at most ``LIGHT_ROWS`` / 2 rows a rating, whatever the pairs.  The few
other users are reached by a *probe*: a pair is expanded by the busy raters of
whichever item has fewer of them (the drive side) and each (rater, other item)
is looked up in their ratings by an equi-join.  So no pair is expanded by all
its raters, a user holding a third of all ratings does not square the work, and
no group is collected into one task.

What is shuffled is *packed*: an item against arrays of a user's other items, of
at most about ``CHUNK_ROWS`` entries each, never a row a pair.  Asked pairs and
co-ratings go to their item in one shuffle and are opened there; what is asked
for, the means, the sums and (``Sides.neighbours``) the candidates' weights and
the best of them are made in that task, without another shuffle.

Centred sums use the all-ratings item means, which every pair carries from its
candidates, so every co-rating contributes (r_i - m_i)(r_j - m_j) directly and
a zero norm is an exact zero.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import session as SE
from ..functions import similarity as S


#: rows of a key that one block holds, on either side of an expanding join
BLOCK_ROWS = 512


def blocked_join(left: DataFrame, right: DataFrame, on: str, left_by: str, right_by: str,
                 rows: int = BLOCK_ROWS) -> DataFrame:
    """Inner join on ``on`` whose hot keys are cut into blocks on both sides.

    A key with more than ``rows`` rows on a side is dealt by hash of that
    side's ``*_by`` column into blocks of about ``rows`` rows; each block is
    repeated for the blocks of the other side, so every pair meets exactly
    once and no (key, block, block) yields much more than ``rows`` ** 2 rows.
    Other keys are joined as they are.  The partition count is fixed by
    ``spark.sql.shuffle.partitions``: adaptive execution would judge blocks by
    their small input and put all of a key's blocks in one task again.
    """
    n = max(1, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    count = F.ceil(F.count(F.lit(1)) / rows).cast("int")
    cut = (left.groupBy(on).agg(count.alias("_lb")).join(right.groupBy(on).agg(count.alias("_rb")), on)
           .where("_lb > 1 OR _rb > 1"))

    def block(by: str, blocks: str):
        return F.pmod(F.xxhash64(by), F.coalesce(F.col(blocks), F.lit(1))).cast("int")

    def every(blocks: str):
        return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(blocks), F.lit(1)) - 1))

    lo = (left.join(cut, on, "left").withColumn("_l", block(left_by, "_lb")).withColumn("_r", every("_rb"))
          .drop("_lb", "_rb").repartition(n, on, "_l", "_r"))
    ro = (right.join(cut, on, "left").withColumn("_r", block(right_by, "_rb")).withColumn("_l", every("_lb"))
          .drop("_lb", "_rb").repartition(n, on, "_l", "_r"))
    return lo.join(ro, [on, "_l", "_r"]).drop("_l", "_r")


def candidate_neighbours(warm_targets: DataFrame, r: DataFrame, item_stats: DataFrame | None = None) -> DataFrame:
    """Target x the user's deduplicated history, hot users in blocks; with ``item_stats`` also both means, ``m`` and ``neighbour_m``."""
    warm = warm_targets.select("user_id", "item_id")
    nb = r.select("user_id", F.col("item_id").alias("neighbour_id"), "stars")
    if item_stats is not None:      # met by the two small tables, not by their product
        warm = warm.join(item_stats.select("item_id", F.col("mean_stars").alias("m")), "item_id")
        nb = nb.join(item_stats.select(F.col("item_id").alias("neighbour_id"), F.col("mean_stars").alias("neighbour_m")), "neighbour_id", "left")
    return blocked_join(warm, nb, "user_id", "item_id", "neighbour_id")


def with_pair_key(df: DataFrame, a: str = "item_id", b: str = "neighbour_id") -> DataFrame:
    """Canonical unordered pair key (item_i <= item_j)."""
    return df.withColumn("item_i", F.least(a, b)).withColumn("item_j", F.greatest(a, b))


def keyed_means(cands: DataFrame) -> DataFrame:
    """item_i, item_j, m_i, m_j of every candidate (with both means): pairs as often as targets ask for them."""
    def mean(key: str):
        return F.when(F.col(key) == F.col("item_id"), F.col("m")).otherwise(F.col("neighbour_m"))

    return with_pair_key(cands).select("item_i", "item_j", mean("item_i").alias("m_i"), mean("item_j").alias("m_j"))


def candidate_pairs(cands: DataFrame) -> DataFrame:
    return with_pair_key(cands).select("item_i", "item_j").distinct()


def driven(pairs: DataFrame, raters: DataFrame) -> DataFrame:
    """``pairs`` with drive and probe: its less- and its more-rated item; ``raters``: item_id, n and columns to attach as ``_i``, ``_j``."""
    more = [c for c in raters.columns if c not in ("item_id", "n")]
    i, j = (raters.select(F.col("item_id").alias(f"item_{k}"), F.col("n").alias(f"d_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in more]) for k in "ij")
    first = F.col("d_i") <= F.col("d_j")
    return (pairs.join(i, "item_i").join(j, "item_j")
            .select("item_i", "item_j", *[f"{c}_{k}" for c in more for k in "ij"],
                    F.when(first, F.col("item_i")).otherwise(F.col("item_j")).alias("drive"),
                    F.when(first, F.col("item_j")).otherwise(F.col("item_i")).alias("probe")))


def probed(p: DataFrame, r: DataFrame) -> DataFrame:
    """item_i, item_j, r_i, r_j of every user of ``r`` who rated both items of a pair (drive, probe).

    The expansion carries only (drive, probe, user, rating); item order is
    restored after the probe, on the rows that found a co-rater.
    """
    rd = r.select(F.col("item_id").alias("drive"), "user_id", F.col("stars").alias("r_d"))
    rp = r.select(F.col("item_id").alias("probe"), "user_id", F.col("stars").alias("r_p"))
    hits = (blocked_join(p.select("drive", "probe"), rd, "drive", "probe", "user_id")
            .join(rp, ["probe", "user_id"]))
    d_first = F.col("drive") <= F.col("probe")
    return hits.select(F.least("drive", "probe").alias("item_i"),
                       F.greatest("drive", "probe").alias("item_j"),
                       F.when(d_first, F.col("r_d")).otherwise(F.col("r_p")).alias("r_i"),
                       F.when(d_first, F.col("r_p")).otherwise(F.col("r_d")).alias("r_j"))


#: a user with at most so many ratings of items in pairs has them paired with each other
LIGHT_ROWS = 256
#: pairs of one task where statistics are made, beyond what the set number of partitions gives
TASK_ROWS = 1_000_000


def split_by_rows(rows: DataFrame, key: str, most: int) -> tuple[DataFrame, DataFrame | None]:
    """``rows`` whose ``key`` has at most ``most`` of them, and the others (None without any)."""
    heavy = SE.materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(key), "heavy_keys")
    if heavy.isEmpty():
        return rows, None
    return rows.join(heavy, key, "left_anti"), rows.join(heavy, key, "left_semi")


def raters_of(pairs: DataFrame | None, r: DataFrame, items: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Ratings of items in pairs: those of light users and those of the others (None without any)."""
    if items is None:
        items = pairs.select(F.explode(F.array("item_i", "item_j")).alias("item_id")).distinct()
    # users without other items in pairs make no rows
    r = r.select("user_id", "item_id", "stars").where("user_id IS NOT NULL").join(items.select("item_id"), "item_id", "left_semi")
    return split_by_rows(r, "user_id", LIGHT_ROWS)


def probed_by_fewer(pairs: DataFrame, heavy: DataFrame) -> DataFrame:
    """item_i, item_j, r_i, r_j of ``heavy`` for all of ``pairs``, driven by the item with fewer of these raters."""
    raters = heavy.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    return probed(driven(pairs.select("item_i", "item_j").distinct(), raters), heavy)


def co_ratings(pairs: DataFrame, r: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """item_i, item_j, r_i, r_j of every user who rated both items: for all of ``pairs``, and for others that light users make.

    ``items`` (item_id) has the items of ``pairs``, where that is known at less cost; ``pairs`` may repeat.
    """
    light, heavy = raters_of(pairs, r, items)
    two = [light.select("user_id", F.col("item_id").alias(f"item_{k}"), F.col("stars").alias(f"r_{k}")) for k in "ij"]
    found = two[0].join(two[1], "user_id").where(F.col("item_i") <= F.col("item_j")).select("item_i", "item_j", "r_i", "r_j")
    return found if heavy is None else found.unionByName(probed_by_fewer(pairs, heavy))


#: entries of one array, about: what a user's history and targets are cut into
CHUNK_ROWS = 256


def chunked(rows: DataFrame, *values: str) -> DataFrame:
    """user_id, chunk, packed: ``rows`` (user_id, item_id, ``values``) in arrays of structs (``values``, j), in the order of ``values``."""
    many = rows.groupBy("user_id").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("_n"))
    chunk = F.pmod(F.xxhash64("item_id"), F.col("_n")).cast("int").alias("chunk")
    # equal values side by side: they shrink in the shuffle
    return (rows.join(many, "user_id").groupBy("user_id", chunk)
            .agg(F.sort_array(F.collect_list(F.struct(*values, F.col("item_id").alias("j")))).alias("packed")))


def _packed(rows: DataFrame, own: str, is_co: bool, value: str, *more: Column | str) -> DataFrame:
    """item_i, own, is_co, j, v of rows (item_id, ``own``, packed)."""
    return (rows.where(F.size("packed") > 0)
            .select(F.col("item_id").alias("item_i"), F.col(own).alias("own"), F.lit(is_co).alias("is_co"),
                    F.col("packed.j").alias("j"), F.col(f"packed.{value}").alias("v"), *more))


def _singles(pairs: DataFrame, i: str, j: str, own: str, v: str, is_co: bool, *more: Column | str) -> DataFrame:
    """The same of rows that come one by one."""
    return pairs.select(F.col(i).alias("item_i"), F.col(own).alias("own"), F.lit(is_co).alias("is_co"),
                        F.array(j).alias("j"), F.array(v).alias("v"), *more)


def packed_co_ratings(pairs: DataFrame, r: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """``co_ratings`` packed: item_i, own (r_i), is_co (true), j, v (r_j)."""
    light, heavy = raters_of(pairs, r, items)
    later = F.filter("packed", lambda y: y["j"] >= F.col("item_id"))
    found = _packed(light.join(chunked(light, "stars"), "user_id").withColumn("packed", later), "stars", True, "stars")
    return found if heavy is None else found.unionByName(_singles(probed_by_fewer(pairs, heavy), "item_i", "item_j", "r_i", "r_j", True))


def opened(packed: DataFrame, sizes: DataFrame | None = None, rows: int = 0) -> list[tuple[DataFrame, list[str]]]:
    """``packed`` as one row an entry (item_j and the arrays' values), all rows of a pair in one task; with the columns they are dealt by.

    One shuffle by item.  Items with more than ``TASK_ROWS`` entries, if there
    are any, are a second table, cut into blocks by hash of the other item.
    ``sizes`` (item_id, n): entries of an item at most, where known at less
    cost; ``rows``: entries in all at least.  A task takes about ``TASK_ROWS``.
    """
    if sizes is None:
        sizes = SE.materialize(packed.groupBy(F.col("item_i").alias("item_id")).agg(F.sum(F.size("j")).alias("n")), "pair_sizes")
        rows = max(rows, sizes.agg(F.sum("n")).first()[0] or 0)
    cut = SE.materialize(sizes.where(F.col("n") > TASK_ROWS).select(F.col("item_id").alias("item_i"), F.ceil(F.col("n") / TASK_ROWS).cast("int").alias("_k")), "hot_items")
    tasks = max(int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // TASK_ROWS)
    arrays = [f.name for f in packed.schema if f.dataType.typeName() == "array"]
    one = [c for c in packed.columns if c not in arrays]
    entries = F.arrays_zip(*arrays)

    def rows_of(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
        return (df.repartition(tasks, *by).select(*one, *by[1:], F.explode(entries).alias("e"))
                .select(*one, *by[1:], *[F.col(f"e.{a}").alias("item_j" if a == "j" else a) for a in arrays]), by)

    if cut.isEmpty():
        return [rows_of(packed, ["item_i"])]
    kept = F.filter(entries, lambda x: F.pmod(F.xxhash64(x["j"]), F.col("_k")).cast("int") == F.col("block"))
    hot = (packed.join(cut, "item_i").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("_k") - 1)))
           .withColumn("_e", kept).where(F.size("_e") > 0).select(*one, "block", *[F.col(f"_e.{a}").alias(a) for a in arrays]))
    return [rows_of(packed.join(cut, "item_i", "left_anti"), ["item_i"]), rows_of(hot, ["item_i", "block"])]


def asked_rows(rows: DataFrame, by: list[str]) -> tuple[DataFrame, Window]:
    """Rows of asked pairs with m_i, m_j and, for co-ratings, r_i, r_j and ``_co``; and the window of a pair."""
    w = Window.partitionBy(*by, "item_j")
    co = F.col("is_co")
    return (rows.withColumn("_asked", F.max(~co).over(w)).withColumn("m_i", F.max(F.when(~co, F.col("own"))).over(w))
            .withColumn("m_j", F.max(F.when(~co, F.col("v"))).over(w)).where("_asked")
            .withColumn("r_i", F.when(co, F.col("own"))).withColumn("r_j", F.when(co, F.col("v")))
            .withColumn("_co", F.when(co, 1)).drop("_asked", "own", "v", "is_co")), w


def _sums() -> dict[str, Column]:
    """Sums over a pair's co-ratings; a rating without stars counts as well."""
    r_i, r_j = F.col("r_i"), F.col("r_j")
    ci, cj = r_i - F.col("m_i"), r_j - F.col("m_j")
    return {"n_co": F.count("_co"), **{name: F.sum(c) for name, c in
            (("s_close", S.closeness(r_i, r_j)), ("s_ij", ci * cj), ("ss_i", ci * ci), ("ss_j", cj * cj))}}


def _filled(name: str) -> Column:
    return F.col(name) if name == "n_co" else F.coalesce(name, F.lit(0.0)).alias(name)


def _statistics(parts: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    out = []
    for part, by in parts:
        met, _ = asked_rows(part, by)
        sums = met.groupBy(*by, "item_j").agg(F.min("m_i").alias("m_i"), F.min("m_j").alias("m_j"), *[c.alias(name) for name, c in _sums().items()])
        out.append(sums.select("item_i", "item_j", "m_i", "m_j", *[_filled(name) for name in _sums()]))
    return reduce(DataFrame.unionByName, out)


def pair_statistics(pairs: DataFrame, r: DataFrame, item_stats: DataFrame,
                    materialize: bool = False, items: DataFrame | None = None, rows: int = 0) -> DataFrame:
    """Per pair: n_co and the centred / closeness sums over co-raters.

    ``pairs`` may repeat and may carry the means m_i, m_j; ``rows`` is about how
    many it has, where known (a task takes about ``TASK_ROWS``).
    Output: item_i, item_j, m_i, m_j, n_co, s_close, s_ij, ss_i, ss_j.  Pairs
    without co-raters keep n_co = 0 (they are scored from the item means).
    With ``materialize`` the table is written once to the checkpoint folder.
    """
    if "m_i" not in pairs.columns:
        means = item_stats.select("item_id", "mean_stars")
        pairs = pairs.join(means.toDF("item_i", "m_i"), "item_i").join(means.toDF("item_j", "m_j"), "item_j")
    asked = _singles(pairs, "item_i", "item_j", "m_i", "m_j", False)
    out = _statistics(opened(asked.unionByName(packed_co_ratings(pairs, r, items)), rows=rows))
    return SE.materialize(out, "cf_pairs") if materialize else out


class Sides:
    """Targets and ratings of the items in their pairs, met user by user.

    ``rows``: user_id, item_id, m (the item's mean), stars, is_target, asked
    (some target is for the item), packed (arrays of the same user's rows, j
    being their item).  A user with at most ``LIGHT_ROWS`` rows is one array;
    of the others the arrays are chunks, and co-ratings come by the probe.
    """

    def __init__(self, warm: DataFrame, r: DataFrame, item_stats: DataFrame, pairs: Callable[[], DataFrame]) -> None:
        warm, r = warm.select("user_id", "item_id"), r.select("user_id", "item_id", "stars").where("user_id IS NOT NULL")
        own = r.join(warm.select("user_id").distinct(), "user_id", "left_semi")
        items = (warm.select("item_id", F.lit(True).alias("asked")).unionByName(own.select("item_id", F.lit(False).alias("asked")))
                 .groupBy("item_id").agg(F.max("asked").alias("asked")))
        means = item_stats.select("item_id", F.col("mean_stars").alias("m")).join(items, "item_id")
        stars = F.lit(None).cast(r.schema["stars"].dataType).alias("stars")
        u = SE.materialize(warm.select("*", stars, F.lit(True).alias("is_target")).unionByName(r.withColumn("is_target", F.lit(False)))
                           .join(means, "item_id"), "cf_sides")
        # a rating without item makes the pair of the target with itself, as least and greatest do
        self.unnamed = u.where("is_target").drop("stars").join(r.where("item_id IS NULL").select("user_id", "stars"), "user_id")
        t = F.col("is_target")
        users = SE.materialize(u.groupBy("user_id").agg(F.count(F.when(t, 1)).alias("t"), F.count(F.when(~t, 1)).alias("h")), "cf_users")
        n = F.col("t") + F.col("h")
        self.entries = users.agg(F.sum(F.col("h") * (F.col("t") + F.least("h", F.lit(LIGHT_ROWS))))).first()[0] or 0
        busy = SE.materialize(users.where(n > LIGHT_ROWS).select("user_id", n.alias("_n")), "heavy_keys")
        heavy = None if busy.isEmpty() else u.join(busy.select("user_id"), "user_id", "left_semi")
        light = u if heavy is None else u.join(busy, "user_id", "left_anti")
        values = ["stars", "is_target", "m", "asked"]
        x = F.col("x")
        arrays = light.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(*values, F.col("item_id").alias("j")))).alias("packed"))
        self.light = (arrays.select("user_id", "packed", F.explode("packed").alias("x"))
                      .select("user_id", "packed", x["j"].alias("item_id"), *[x[v].alias(v) for v in values]))
        self.rows, self.hits = self.light, None
        sized = u.withColumn("_n", F.lit(LIGHT_ROWS).cast("long"))
        if heavy is not None:
            self.rows = self.light.unionByName(blocked_join(heavy, chunked(heavy, *values), "user_id", "item_id", "chunk").drop("chunk"))
            self.hits = probed_by_fewer(pairs(), heavy.where(~t).select("user_id", "item_id", "stars"))
            sized = u.join(busy, "user_id", "left").withColumn("_n", F.coalesce("_n", F.lit(LIGHT_ROWS).cast("long")))
        self.sizes = sized.groupBy("item_id").agg(F.sum("_n").alias("n"))       # what a row can meet at most

    def pairs(self, exclude_self: bool = False, means: bool = True) -> DataFrame:
        """The candidates' pairs packed: item_i, own (m_i), is_co (false), j, v (m_j); a pair as often as targets ask for it.

        Without ``means`` own is null and v empty: nothing but the pairs is shuffled.
        """
        i, t = F.col("item_id"), F.col("is_target")
        other = F.filter("packed", lambda y: (y["is_target"] != t) & ((y["j"] > i) | ((y["j"] == i) & t & F.lit(not exclude_self))))
        out = _packed(self.rows.withColumn("packed", other), "m", False, "m")
        if not exclude_self:
            out = out.unionByName(_singles(self.unnamed.withColumn("m_j", F.col("m")), "item_id", "item_id", "m", "m_j", False))
        if means:
            return out
        # the other arrays' entries have no partner in an empty one: null
        return (out.withColumn("own", F.lit(None).cast(out.schema["own"].dataType))
                .withColumn("v", F.array().cast(out.schema["v"].dataType)))

    def met(self, exclude_self: bool = False, means: bool = True) -> list[tuple[DataFrame, list[str]]]:
        """``opened`` pairs and co-ratings of the candidates."""
        t = F.col("is_target")
        later = F.filter("packed", lambda y: ~y["is_target"] & (y["j"] >= F.col("item_id")))
        out = self.pairs(exclude_self, means).unionByName(_packed(self.light.where(~t).withColumn("packed", later), "stars", True, "stars"))
        if self.hits is not None:
            out = out.unionByName(_singles(self.hits, "item_i", "item_j", "r_i", "r_j", True))
        return opened(out, self.sizes, self.entries)

    def statistics(self, exclude_self: bool = False) -> DataFrame:
        """``pair_statistics`` of the candidates' pairs."""
        return _statistics(self.met(exclude_self))

    def neighbours(self, exclude_self: bool = False) -> list[DataFrame]:
        """Candidates with their pair's weight, those kept: ``weighted_neighbours`` without a table of pairs.

        Every target carries its user's history to its item, every rating of the
        item its user's others, so a pair's sums are made where its candidates are.
        Each table is dealt by item_id, so windows and aggregates by (user_id,
        item_id) stay in their task; a second one has the hot items, if any.
        """
        t = F.col("is_target")
        history = F.filter("packed", lambda y: ~y["is_target"] & ((y["j"] != F.col("item_id")) | F.lit(not exclude_self)))
        more = F.col("packed.stars").alias("stars"), "user_id"
        asked = _packed(self.rows.where(t).withColumn("packed", history), "m", False, "m", *more, F.lit(False).alias("unnamed"))
        if not exclude_self:
            asked = asked.unionByName(_singles(self.unnamed.withColumn("m_j", F.col("m")), "item_id", "item_id", "m", "m_j", False,
                                               F.array("stars").alias("stars"), "user_id", F.lit(True).alias("unnamed")))
        co = _packed(self.light.where(~t & F.col("asked")).withColumn("packed", F.filter("packed", lambda y: ~y["is_target"])), "stars", True, "stars")
        if self.hits is not None:
            co = co.unionByName(_singles(self.hits, "item_i", "item_j", "r_i", "r_j", True))
            co = co.unionByName(_singles(self.hits.where("item_i != item_j"), "item_j", "item_i", "r_j", "r_i", True))
        none = [F.lit(None).cast(asked.schema[c].dataType).alias(c) for c in ("user_id", "unnamed")]
        empty = F.array().cast(asked.schema["stars"].dataType).alias("stars")
        out = []
        for part, by in opened(asked.unionByName(co.select("*", empty, *none)), self.sizes, self.entries):
            rows, w = asked_rows(part, by)
            rows = rows.select("*", *[c.over(w).alias(name) for name, c in _sums().items()]).where("_co IS NULL")
            scored = pair_weights(rows.select("item_i", "item_j", "m_i", "m_j", "user_id", "stars", "unnamed", *[_filled(name) for name in _sums()]))
            out.append(scored.select("user_id", F.col("item_i").alias("item_id"), F.when(~F.col("unnamed"), F.col("item_j")).alias("neighbour_id"),
                                     "stars", "n_co", "raw_w", "weight"))
        return out


def pair_weights(stats: DataFrame, kept_only: bool = True) -> DataFrame:
    """Raw weight, keep flag and amplified weight per pair."""
    n = F.col("n_co")
    raw = S.raw_weight(n, F.col("m_i"), F.col("m_j"), F.col("s_close"),
                       F.col("s_ij"), F.col("ss_i"), F.col("ss_j"))
    out = (stats.withColumn("raw_w", raw)
           .withColumn("keep", S.keep(n, F.col("raw_w")))
           .withColumn("weight", S.amplify(F.col("raw_w"))))
    return out.where("keep") if kept_only else out


def weighted_neighbours(cands: DataFrame, weights: DataFrame) -> DataFrame:
    """Candidates joined to the kept pair weights (J7)."""
    w = weights.select("item_i", "item_j", "n_co", "raw_w", "weight")
    # a sort-merge join (the planner's choice): it spills, where a shuffled
    # hash join must hold a partition's pair weights in memory
    return with_pair_key(cands).join(w, ["item_i", "item_j"])
