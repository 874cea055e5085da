"""Command-line jobs: file inputs -> prediction file, one per predictor.

    python -m tastebud.jobs cf     TRAIN_CSV TARGETS_CSV OUT_DIR [--n 30] [--exclude-self]
    python -m tastebud.jobs model  FOLDER TARGETS_CSV OUT_DIR [--rounds 383]
    python -m tastebud.jobs hybrid FOLDER TARGETS_CSV OUT_DIR [--rounds 383]

FOLDER holds ``train.csv``, ``val.csv``, ``items.json`` and
``users.json`` (names configurable).  Output is a folder with the prediction
CSV (header ``user_id, business_id, prediction``) in target-file order: file
path, then place in the file, used only by the final range-partitioned sort.
Tables written on the way are removed at the end.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import session as SE
from .operators import cf as CF
from .operators import embed as EM
from .operators import hybrid as HY
from .operators import model as MO
from .sources import readers, sinks


#: file order of targets over any number of files
ORDER = readers.PLACE


def _targets(spark: SparkSession, path: str) -> DataFrame:
    return SE.materialize(readers.read_targets(spark, path, place=True), "job_targets")


def cf_job(spark: SparkSession, train_csv: str, targets_csv: str, out: str, n: int = 30,
           exclude_self: bool = False) -> DataFrame:
    train = readers.read_ratings(spark, train_csv)
    t = _targets(spark, targets_csv)
    pred = CF.cf_predict(train, t.select("user_id", "item_id").distinct(), n=n,
                         exclude_self=exclude_self, decimals=None)
    res = t.join(pred.select("user_id", "item_id", "prediction"), ["user_id", "item_id"], "left")
    sinks.write_predictions(res, out, order_col=ORDER)
    return res


def _model_inputs(spark, folder, train_name, val_name, items_name, users_name):
    tr = readers.read_ratings(spark, os.path.join(folder, train_name)).withColumn("split", F.lit("train"))
    va = readers.read_ratings(spark, os.path.join(folder, val_name)).withColumn("split", F.lit("val"))
    items = readers.read_items(spark, os.path.join(folder, items_name))
    users = readers.read_users(spark, os.path.join(folder, users_name))
    return tr.unionByName(va), users, items


def model_job(spark, folder, targets_csv, out, rounds=383, hybrid=False,
              train_name="train.csv", val_name="val.csv",
              items_name="items.json", users_name="users.json",
              embed: EM.EmbedParams = EM.EmbedParams()) -> DataFrame:
    ratings, users, items = _model_inputs(spark, folder, train_name, val_name, items_name, users_name)
    t = _targets(spark, targets_csv)
    pairs = t.select("user_id", "item_id").distinct()
    run = MO.run_model(ratings, users, items, pairs, MO.GBTParams(rounds=rounds), embed)
    scored = run.targets
    if hybrid:
        train = ratings.where(F.col("split") == "train").select("user_id", "item_id", "stars")
        cf = CF.cf_predict(train, pairs, decimals=None)
        scored = HY.blend_scores(scored.withColumn("model", F.col("model_score")),
                                 cf.select("user_id", "item_id", F.col("prediction").alias("cf"),
                                           "n_neighbours"), decimals=None)
    scored = SE.materialize(scored.select("user_id", "item_id", "prediction"), "job_scores")
    res = t.join(scored, ["user_id", "item_id"], "left")
    sinks.write_predictions(res, out, order_col=ORDER)
    return res


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tastebud.jobs")
    ap.add_argument("kind", choices=["cf", "model", "hybrid"])
    ap.add_argument("inputs")
    ap.add_argument("targets")
    ap.add_argument("out")
    ap.add_argument("--n", type=int, default=30)
    ap.add_argument("--exclude-self", action="store_true",
                    help="CF: do not use a target's own rating as a neighbour")
    ap.add_argument("--rounds", type=int, default=383)
    ap.add_argument("--embed-passes", type=int, default=EM.EmbedParams.passes)
    ap.add_argument("--embed-lr", type=float, default=EM.EmbedParams.batch_lr)
    a = ap.parse_args(argv)
    spark = SE.build_session(app=f"tastebud-{a.kind}")
    with SE.released(spark):
        if a.kind == "cf":
            cf_job(spark, a.inputs, a.targets, a.out, a.n, a.exclude_self)
        else:
            model_job(spark, a.inputs, a.targets, a.out, a.rounds, hybrid=a.kind == "hybrid",
                      embed=EM.EmbedParams(passes=a.embed_passes, batch_lr=a.embed_lr))
    spark.stop()


if __name__ == "__main__":
    main()
