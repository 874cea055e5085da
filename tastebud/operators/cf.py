"""Item-based collaborative filtering: one logical plan from ratings to scores.

    train rows ─ dedup ─┬─ item means ───────────────┐
                        ├─ candidate neighbours ─ pairs ─ pair stats ─ weights
    targets ─ routes ───┘                                               │
       └────────────── top-N window ─ weighted mean ─ route select ─────┘

Cold cases: unknown user -> 3.75; known user, unknown item -> the user's
mean over raw rows; otherwise the weighted mean of the top-N neighbours, or
the user's mean when no neighbour survives.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import routes as RT
from ..functions import similarity as S
from .. import session as SE
from . import ratings as RA
from . import similarity as SIM


def route_targets(targets: DataFrame, user_mean: DataFrame, item_stats: DataFrame) -> DataFrame:
    """Left-join the known-user / known-item flags and the user mean."""
    um = user_mean.select("user_id", F.col("mean_stars").alias("user_mean"))
    ik = item_stats.select("item_id", F.lit(True).alias("item_known"))
    t = targets.join(um, "user_id", "left").join(ik, "item_id", "left")
    return t.withColumn("route", RT.route(F.col("user_mean").isNotNull(),
                                          F.col("item_known").isNotNull()))


def top_neighbours(neigh: DataFrame, n: int = S.TOP_N) -> DataFrame:
    """Top-n neighbours per target by weight, ties by neighbour id.

    ``row_number() <= n`` is planned as a window group limit, applied before
    the shuffle as well, so a target with a huge history sends at most n rows
    per task.
    """
    w = Window.partitionBy("user_id", "item_id").orderBy(
        S.rank_key(F.col("raw_w")).desc(), F.col("neighbour_id").asc())
    return neigh.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def weighted_mean(top: DataFrame) -> DataFrame:
    return (top.groupBy("user_id", "item_id")
            .agg(F.sum(F.col("weight") * F.col("stars")).alias("num"),
                 F.sum(F.abs("weight")).alias("den"),
                 F.count(F.lit(1)).alias("n_neighbours")))


@dataclass
class CFTrain:
    """Train-side tables of CF, independent of the targets (prepare once)."""
    dedup: DataFrame          # user_id, item_id, stars, s_raw, n_raw
    user_mean: DataFrame
    item_stats: DataFrame


def prepare(train: DataFrame, dedup_how: str = "max", materialize: bool = True) -> CFTrain:
    """Deduplicated ratings (max, raw sum, raw count per pair), user means over
    raw rows and item means / rater counts.

    With ``materialize`` the deduplicated table is written once to the shared
    checkpoint folder: it feeds four consumers whose pruned sub-plans differ,
    so Spark could not reuse their shuffles, and the lineage is cut there.
    """
    r = RA.dedup_with_raw(train, dedup_how)
    if materialize:
        r = SE.materialize(r, "cf_dedup")
    items = RA.item_mean(r)     # read by the routes and by four joins
    if materialize:
        items = SE.materialize(items, "cf_items")
    return CFTrain(r, RA.user_mean_from_dedup(r), items)


WEIGHT_COLS = ["item_i", "item_j", "n_co", "raw_w", "keep", "weight"]


class CFParts:
    """The stages of one CF run, each planned (and written, if shared) when first read.

    A caller that reads ``routed`` or ``pairs`` alone never writes the pair table.
    """

    def __init__(self, prepared: CFTrain, targets: DataFrame, n: int, exclude_self: bool,
                 materialize: bool, known_weights: DataFrame | None) -> None:
        self.train, self.targets, self.n = prepared, targets, n
        self.exclude_self, self.materialize, self.known = exclude_self, materialize, known_weights
        self.dedup = prepared.dedup.select("user_id", "item_id", "stars")
        self.user_mean, self.item_stats = prepared.user_mean, prepared.item_stats

    @cached_property
    def routed(self) -> DataFrame:
        t = route_targets(self.targets, self.user_mean, self.item_stats)
        return SE.materialize(t, "cf_routed") if self.materialize else t

    @cached_property
    def warm(self) -> DataFrame:
        return self.routed.where(F.col("route") == RT.BOTH).select("user_id", "item_id")

    def _candidates(self, item_stats: DataFrame | None = None) -> DataFrame:
        c = SIM.candidate_neighbours(self.warm, self.train.dedup, item_stats)
        return c.where(F.col("item_id") != F.col("neighbour_id")) if self.exclude_self else c

    @cached_property
    def candidates(self) -> DataFrame:
        return self._candidates()

    @cached_property
    def pairs(self) -> DataFrame:
        return SIM.candidate_pairs(self.candidates)

    @cached_property
    def sides(self) -> SIM.Sides:
        return SIM.Sides(self.warm, self.dedup, self.item_stats, lambda: self.pairs)

    @cached_property
    def stats(self) -> DataFrame:
        if self.known is None:      # who reads it once takes sides.statistics(): the table is larger than what it is made of
            made = self.sides.statistics(self.exclude_self)
            return SE.materialize(made, "cf_pairs") if self.materialize else made
        todo = SIM.keyed_means(self._candidates(self.item_stats))
        todo = todo.join(self.known.select("item_i", "item_j"), ["item_i", "item_j"], "left_anti")
        # the items of the pairs: those of the warm targets and of their users' histories
        own = self.dedup.join(self.warm.select("user_id").distinct(), "user_id", "left_semi")
        items = self.warm.select("item_id").unionByName(own.select("item_id")).distinct()
        return SIM.pair_statistics(todo, self.dedup, self.item_stats, materialize=self.materialize, items=items)

    @cached_property
    def evaluated(self) -> DataFrame:
        """Pairs scored in this run, kept or not."""
        return SIM.pair_weights(self.stats, kept_only=False).select(*WEIGHT_COLS)

    @cached_property
    def weights(self) -> DataFrame:
        if self.known is None:
            return self.evaluated.where("keep")
        return self.known.select(*WEIGHT_COLS).unionByName(self.evaluated).where("keep")

    @cached_property
    def _parts(self) -> list[DataFrame]:
        """Kept neighbours in one table or two, none of which has another's targets."""
        if self.known is not None or "evaluated" in self.__dict__:
            return [SIM.weighted_neighbours(self.candidates, self.weights)]
        return self.sides.neighbours(self.exclude_self)

    def _union(self, step) -> DataFrame:
        return reduce(DataFrame.unionByName, [step(part) for part in self._parts])

    @cached_property
    def neighbours(self) -> DataFrame:
        return self._union(lambda part: part)

    @cached_property
    def top(self) -> DataFrame:
        # limited in each table, then ranked whole, whichever table has a target's rows
        return top_neighbours(self._union(lambda part: top_neighbours(part, self.n).drop("rank")), self.n)

    @cached_property
    def scores(self) -> DataFrame:
        return self._union(lambda part: weighted_mean(top_neighbours(part, self.n)))


def cf_parts(train: DataFrame | None, targets: DataFrame, n: int = S.TOP_N,
             exclude_self: bool = False, dedup_how: str = "max",
             materialize: bool = True, prepared: CFTrain | None = None,
             known_weights: DataFrame | None = None) -> CFParts:
    """The stages of a CF run over ``targets``.

    ``train``: (user_id, item_id, stars) raw rows (or ``prepared`` tables from
    :func:`prepare`); ``targets``: (user_id, item_id, ...) distinct pairs.
    ``exclude_self`` drops b0 = b from the candidates (off by default, as in
    the surveyed behaviour).  With ``materialize`` the routed targets and the
    pair statistics are written once (two consumers each).

    ``known_weights`` (``WEIGHT_COLS``, kept and dropped pairs, computed from
    the same train table) is a memo of earlier runs: only candidate pairs
    missing from it are scored (anti join), and ``evaluated`` returns the newly
    scored ones so a caller can extend the memo.
    """
    return CFParts(prepared or prepare(train, dedup_how, materialize), targets, n,
                   exclude_self, materialize, known_weights)


def predict(parts: CFParts, decimals: int | None = 6) -> DataFrame:
    """(user_id, item_id, prediction, n_neighbours, route) for every target."""
    t = parts.routed.join(parts.scores, ["user_id", "item_id"], "left")
    route = F.col("route")
    neighbour_score = F.col("num") / F.nullif(F.col("den"), F.lit(0.0))
    pred = (F.when(route == RT.BOTH, F.coalesce(neighbour_score, F.col("user_mean")))
            .when(route == RT.USER_ONLY, F.col("user_mean"))
            .otherwise(F.lit(RT.COLD_DEFAULT)))
    if decimals is not None:
        pred = F.round(pred, decimals)
    extra = [c for c in parts.routed.columns
             if c not in ("user_id", "item_id", "user_mean", "item_known", "route")]
    return t.select("user_id", "item_id", pred.alias("prediction"),
                    F.coalesce("n_neighbours", F.lit(0)).cast("bigint").alias("n_neighbours"),
                    "route", *extra)


def cf_predict(train: DataFrame | None, targets: DataFrame, n: int = S.TOP_N,
               exclude_self: bool = False, decimals: int | None = 6,
               prepared: CFTrain | None = None) -> DataFrame:
    return predict(cf_parts(train, targets, n, exclude_self, prepared=prepared), decimals)
