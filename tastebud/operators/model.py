"""Model-based predictor: routes, feature assembly, boosted trees.

Routes (a key is known when it occurs in train or val):
  both known -> model score; user only -> the user's ``average_stars``;
  item only -> the item's ``stars``; neither -> 3.75.  A one-sided route
  whose profile value is missing falls back to 3.75.

Features of a target depend only on its keys, so they come from two
dimension joins (user profile, item profile + embedding); no positional
alignment of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import routes as RT
from ..sources.schemas import BASE_FEATURES, EMBED_DIM
from . import boost as BO
from . import features as FE

EMBED_COLS = [f"e{k}" for k in range(EMBED_DIM)]


def known_keys(train_val: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct users and items of train ∪ val."""
    return (train_val.select("user_id").distinct(), train_val.select("item_id").distinct())


def route_targets(targets: DataFrame, known_users: DataFrame, known_items: DataFrame) -> DataFrame:
    ku = known_users.select("user_id", F.lit(True).alias("_uk"))
    ki = known_items.select("item_id", F.lit(True).alias("_ik"))
    t = targets.join(ku, "user_id", "left").join(ki, "item_id", "left")
    return (t.withColumn("route", RT.route(F.col("_uk").isNotNull(), F.col("_ik").isNotNull()))
            .drop("_uk", "_ik"))


def target_features(routed: DataFrame, users: DataFrame, items: DataFrame,
                    embedding: DataFrame | None = None) -> DataFrame:
    """Base features (and embedding) of each routed target.

    Profiles are attached only for keys known in train ∪ val, as the model
    only ever sees those; other features stay null.
    """
    user_known = F.col("route").isin(RT.BOTH, RT.USER_ONLY)
    item_known = F.col("route").isin(RT.BOTH, RT.ITEM_ONLY)
    out = (routed.join(FE.user_dim(users), "user_id", "left")
           .join(FE.item_dim(items), "item_id", "left"))
    if embedding is not None:
        out = out.join(embedding, "item_id", "left")
    ucols = [c for c in BASE_FEATURES[:6]]
    icols = BASE_FEATURES[6:] + (EMBED_COLS if embedding is not None else [])
    return out.select(
        *[c for c in out.columns if c not in ucols + icols],
        *[F.when(user_known, F.col(c)).alias(c) for c in ucols],
        *[F.when(item_known, F.col(c)).alias(c) for c in icols])


def one_sided(route, model_score):
    """Prediction by route given the model score for 'both'."""
    fallback = F.lit(RT.COLD_DEFAULT)
    return (F.when(route == RT.BOTH, model_score)
            .when(route == RT.USER_ONLY, F.coalesce(F.col("average_stars"), fallback))
            .when(route == RT.ITEM_ONLY, F.coalesce(F.col("item_stars"), fallback))
            .otherwise(fallback))


def profile_score():
    """Deterministic stand-in model score: mean of user average and item stars."""
    fb = F.lit(RT.COLD_DEFAULT)
    return (F.coalesce(F.col("average_stars"), fb) + F.coalesce(F.col("item_stars"), fb)) / F.lit(2.0)


# ---------------------------------------------------------------- boosted trees
GBTParams = BO.BoostParams


def feature_columns(with_embedding: bool = True) -> list[str]:
    return BASE_FEATURES + (EMBED_COLS if with_embedding else [])


def tree_table(rows: DataFrame, with_embedding: bool = True, label: str = "stars", train: str | None = None,
               max_bins: int = 256) -> BO.Binned:
    """Binned feature rows; a row's key and label decide its draws.  Missing profiles stay missing."""
    keys = [c for c in ("user_id", "item_id", label) if c in rows.columns]
    columns = feature_columns(with_embedding)
    groups = [BASE_FEATURES[:6], columns[6:]]            # a user's and an item's
    return BO.binned_table(rows, columns, keys, label, train, max_bins, groups)


def fit_gbt(train_rows: DataFrame, p: GBTParams, with_embedding: bool = True, label: str = "stars") -> BO.Forest:
    table = tree_table(train_rows, with_embedding, label, max_bins=p.max_bins)
    booster = BO.Booster(table, p).advance(p.rounds)
    booster.close()
    table.close()
    return booster.forest()


def score(model: BO.Forest, rows: DataFrame, with_embedding: bool = True) -> DataFrame:
    return BO.scored(rows, model, feature_columns(with_embedding))


# ---------------------------------------------------------------- end to end
@dataclass
class ModelRun:
    """Fitted pieces and outputs of one model-based run (lazy DataFrames)."""
    vocab_size: int
    encoder: object
    embedding: DataFrame
    train_rows: DataFrame
    model: BO.Forest
    targets: DataFrame          # routed targets with features and model_score


def run_model(ratings: DataFrame, users: DataFrame, items: DataFrame, targets: DataFrame,
              gbt: GBTParams = GBTParams(), embed=None) -> ModelRun:
    """Embedding fit -> feature rows -> boosted trees -> routed target scores.

    ``ratings``: (user_id, item_id, stars, split); the model trains on train ∪
    val rows.  Small shared tables (item category ids, the embedding) are
    written once to the checkpoint folder, cutting lineage before the
    iterative fits.
    """
    from .. import session as SE
    from . import embed as EM

    embed = embed or EM.EmbedParams()
    tv = ratings.where(F.col("split").isin("train", "val")).select("user_id", "item_id", "stars")
    # each is read by five or more later steps (embedding sets, feature rows,
    # imputer and tree passes, routes): write them once
    tv = SE.materialize(tv, "model_rows")
    users = SE.materialize(users, "model_users")
    items = SE.materialize(items, "model_items")
    vocab = FE.category_vocab(items)
    V = vocab.count()
    ids = SE.materialize(FE.item_category_ids(items, vocab), "item_ids")
    enc = EM.fit_minibatches(EM.training_sets(tv, ids), V, embed)
    emb = SE.materialize(EM.embed_items(tv, ids, enc), "embedding")
    train_rows = FE.feature_rows(tv, users, items).join(emb, "item_id", "left")
    model = fit_gbt(train_rows, gbt)
    ku, ki = known_keys(tv)
    tf = target_features(route_targets(targets, ku, ki), users, items, emb)
    scored = score(model, tf)
    out = scored.withColumn("prediction", one_sided(F.col("route"), F.col("model_score")))
    keep = [c for c in tf.columns] + ["model_score", "prediction"]
    return ModelRun(V, enc, emb, train_rows, model, SE.materialize(out.select(*keep), "model_scored"))


def fit_gbt_early_stopping(train_rows: DataFrame, val_rows: DataFrame, p: GBTParams,
                           patience: int = 100, with_embedding: bool = True,
                           label: str = "stars") -> tuple[BO.Forest, int, list[float]]:
    """Boost on train until ``patience`` rounds bring no better error on val, or ``p.rounds``.

    Returns the forest up to the best round, that round, and the error after
    every round up to the stop.  Nothing is fitted twice: the margins of both
    tables are kept from round to round.
    """
    both = train_rows.withColumn("_train", F.lit(True)).unionByName(val_rows.withColumn("_train", F.lit(False)))
    table = tree_table(both, with_embedding, label, "_train", p.max_bins)
    booster = BO.Booster(table, p)
    best = booster.until(p.rounds, patience)
    booster.close()
    table.close()
    return booster.forest(best), best, booster.errors[:best + patience]
