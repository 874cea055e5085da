"""Embedding, boosted trees, tuner, hybrid blend."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastebud.functions import routes as RT
from tastebud.operators import embed as EM
from tastebud.operators import features as FE
from tastebud.operators import hybrid as HY
from tastebud.operators import model as MO
from tastebud.operators import tune as TU
from tastebud.sources import fixtures as FX


@pytest.fixture(scope="module")
def fixture(spark):
    r = FX.ratings(spark, SF001)
    users, items = FX.users(spark, SF001, r), FX.items(spark, SF001, r)
    vocab = FE.category_vocab(items)
    ids = FE.item_category_ids(items, vocab)
    tv = r.where(F.col("split").isin("train", "val"))
    return r, users, items, vocab.count(), ids, tv


def marginal_loss(sets, vocab_size: int) -> float:
    """Loss of the best constant predictor (per-category frequency): a baseline."""
    V = int(vocab_size)
    e = sets.select(F.explode("ids").alias("k"), "weight")
    tot = float(sets.agg(F.sum("weight")).first()[0])
    freq = np.zeros(V)
    for row in e.groupBy("k").agg(F.sum("weight").alias("w")).collect():   # V rows at most
        freq[int(row["k"])] = row["w"] / tot
    f = np.clip(freq, 1e-12, 1 - 1e-12)
    return float(np.mean(-(f * np.log(f) + (1 - f) * np.log(1 - f))))


def embed_numpy(ids_list, enc) -> np.ndarray:
    """Reference form of the transform for tests: x W + b per id list."""
    out = np.tile(enc.b, (len(ids_list), 1))
    for r, ids in enumerate(ids_list):
        if len(ids):
            out[r] += enc.W[np.asarray(ids, dtype=np.int64)].sum(axis=0)
    return out


def test_embedding_learns_and_sql_transform_matches_numpy(spark, fixture):
    r, users, items, V, ids, tv = fixture
    sets = EM.training_sets(tv, ids)
    enc = EM.fit_autoencoder(sets, V, EM.EmbedParams(steps=25, lr=0.1))
    assert enc.losses[-1] < enc.losses[0]
    assert enc.losses[-1] < marginal_loss(sets, V)
    emb = {row.item_id: [row[f"e{k}"] for k in range(16)] for row in EM.embed_items(tv, ids, enc).collect()}
    id_map = {row.item_id: (row.ids or []) for row in ids.collect()}
    keys = sorted(emb)[:50]
    ref = embed_numpy([id_map.get(k, []) for k in keys], enc)
    assert np.allclose(np.array([emb[k] for k in keys]), ref, atol=1e-9)


def test_minibatches_reach_a_lower_loss_than_full_batches(spark, fixture):
    """Stated loss: below that of 60 full-batch steps, and of the best constant; parts and order do not depend on the input's partitions."""
    r, users, items, V, ids, tv = fixture
    sets = EM.training_sets(tv, ids)
    enc = EM.fit_minibatches(sets, V)
    assert enc.losses[-1] < EM.fit_autoencoder(sets, V).losses[-1] < marginal_loss(sets, V)
    assert enc.losses[-1] == pytest.approx(EM.reconstruction_loss(sets, enc))
    for p in (EM.EmbedParams(least_steps=0), EM.EmbedParams(least_steps=0, rows_per_partition=40)):
        one, two = (EM.fit_minibatches(x, V, p) for x in (sets, sets.repartition(5)))
        assert np.allclose(one.W, two.W, atol=1e-9) and np.allclose(one.U, two.U, atol=1e-9)
        assert len(one.losses) == 3 and one.losses[2] < one.losses[0]
    assert EM.fit_minibatches(sets.limit(0), V).losses == []


def test_block_gradient_is_that_of_differences():
    rng, V, d = np.random.default_rng(3), 7, 3
    import pandas as pd
    pdf = pd.DataFrame({"ids": [[0, 2], [], [6, 1, 3]]})
    theta, weight = rng.normal(0, 1, V * d * 2 + d + V), np.array([0.2, 0.5, 0.3])
    g = np.zeros_like(theta)
    EM._add_gradient(theta, g, *EM._dense(pdf, V), weight, d)
    for k in range(0, theta.size, 5):
        step = np.zeros_like(theta)
        step[k] = 1e-6
        up, down = (EM._add_gradient(theta + s, np.zeros_like(theta), *EM._dense(pdf, V), weight, d) for s in (step, -step))
        assert g[k] == pytest.approx((up - down) / 2e-6, abs=1e-7)


def test_gbt_beats_mean_and_is_deterministic(spark, fixture):
    r, users, items, V, ids, tv = fixture
    rows = FE.feature_rows(tv.select("user_id", "item_id", "stars"), users, items)
    p = MO.GBTParams(rounds=5, max_depth=4)
    m1 = MO.fit_gbt(rows, p, with_embedding=False)
    s1 = MO.score(m1, rows, with_embedding=False)
    mean = rows.agg(F.avg("stars")).first()[0]
    err = s1.agg(F.avg((F.col("model_score") - F.col("stars")) ** 2).alias("m"),
                  F.avg((F.lit(mean) - F.col("stars")) ** 2).alias("b")).first()
    assert err.m <= err.b
    m2 = MO.fit_gbt(rows, p, with_embedding=False)
    a = [x.model_score for x in s1.orderBy("user_id", "item_id", "stars").collect()]
    b = [x.model_score for x in MO.score(m2, rows, with_embedding=False)
         .orderBy("user_id", "item_id", "stars").collect()]
    assert a == b


def test_best_round_patience():
    assert TU.best_round([5, 4, 3, 4, 5, 6], patience=2) == 3
    assert TU.best_round([5, 4, 3, 4, 5, 2], patience=2) == 3
    assert TU.best_round([5, 4, 3, 4, 5, 2], patience=10) == 6


def test_tuner_best_is_minimum_and_few_trials_go_on(spark, fixture):
    r, users, items, V, ids, tv = fixture
    rows = FE.feature_rows(tv.select("user_id", "item_id", "stars", "split"), users, items)
    t = TU.tune(rows.where("split = 'train'"), rows.where("split = 'val'"), TU.SearchSpace(rounds=(6, 9), depth=(2, 3)), trials=5,
                with_embedding=False, start=2, eta=2, parallelism=2, seed=1).collect()
    assert [x.trial for x in t] == list(range(5))
    best = [x for x in t if x.is_best]
    assert len(best) == 1 and best[0].rmse == min(x.rmse for x in t)
    assert all(1 <= x.best_round <= x.rounds_run <= x.rounds for x in t)
    assert sorted(x.rounds_run for x in t)[:2] == [2, 2] and max(x.rounds_run for x in t) >= 6


def test_settings_cover_the_whole_space():
    space = TU.SearchSpace()
    low, high = space.at(np.zeros(6), 1), space.at(np.ones(6), 1)
    assert (low.step_size, low.rounds, low.max_depth, low.subsample, low.feature_subset) == (0.05, 100, 4, 0.8, 0.8)
    assert (high.step_size, high.rounds, high.max_depth, high.subsample, high.feature_subset) == (0.5, 2000, 10, 1.0, 1.0)
    assert low.l2 == pytest.approx(0.1) and high.l2 == pytest.approx(10.0)
    assert space.at(np.full(6, 0.5), 1).l2 == pytest.approx(1.0)


def test_sampler_finds_lower_errors_than_random_draws():
    """Forty trials on a bowl with a ridge, twenty seeds: the median of the best errors is lower."""
    def error(u):
        return (u[0] - 0.2) ** 2 + abs(u[1] - 0.7) + 0.5 * (u[2] - u[3]) ** 2 + 0.1 * math.sin(9 * u[4])

    learned, plain = [], []
    for seed in range(20):
        sampler, rng = TU.ParzenSampler(6, seed), np.random.default_rng(1000 + seed)
        for _ in range(40):
            u = sampler.propose()
            assert ((0 <= u) & (u <= 1)).all()
            sampler.tell(u, error(u))
        learned.append(min(sampler.errors))
        plain.append(min(error(rng.random(6)) for _ in range(40)))
    assert np.median(learned) < np.median(plain)


def test_hybrid_between_scores_and_routes(spark):
    tf = spark.createDataFrame(
        [("u1", "i1", "both", 3.0, 4.0, 2.0), ("u2", "i2", "user_only", 3.5, None, None),
         ("u3", "i3", "item_only", None, 4.5, None), ("u4", "i4", "neither", None, None, None),
         ("u5", "i5", "both", 3.0, 4.0, 4.0)],
        "user_id string, item_id string, route string, average_stars double, item_stars double, model double")
    cf = spark.createDataFrame([("u1", "i1", 5.0, 3), ("u5", "i5", 1.0, 30)],
                               "user_id string, item_id string, cf double, n_neighbours long")
    got = {r.user_id: r for r in HY.blend_scores(tf, cf).collect()}
    assert got["u1"].alpha == RT.ALPHA_FEW and got["u1"].prediction == pytest.approx(0.05 * 5 + 0.95 * 2)
    assert got["u5"].alpha == RT.ALPHA_FULL and got["u5"].prediction == pytest.approx(0.15 * 1 + 0.85 * 4)
    assert got["u2"].prediction == 3.5 and got["u3"].prediction == 4.5 and got["u4"].prediction == 3.75


def test_encoder_and_model_round_trip(spark, fixture, tmpdir_fresh):
    import os

    from tastebud.sources import sinks
    r, users, items, V, ids, tv = fixture
    enc = EM.fit_autoencoder(EM.training_sets(tv, ids), V, EM.EmbedParams(steps=3))
    EM.save_encoder(spark, enc, os.path.join(tmpdir_fresh, "enc"))
    back = EM.load_encoder(spark, os.path.join(tmpdir_fresh, "enc"))
    assert np.array_equal(back.W, enc.W) and np.array_equal(back.U, enc.U)
    assert np.array_equal(back.b, enc.b) and np.array_equal(back.c, enc.c)
    rows = FE.feature_rows(tv.select("user_id", "item_id", "stars"), users, items)
    m = MO.fit_gbt(rows, MO.GBTParams(rounds=2, max_depth=3), with_embedding=False)
    sinks.save_model(m, spark, os.path.join(tmpdir_fresh, "gbt"))
    m2 = sinks.load_model(spark, os.path.join(tmpdir_fresh, "gbt"))
    a = MO.score(m, rows, False).agg(F.sum("model_score")).first()[0]
    b = MO.score(m2, rows, False).agg(F.sum("model_score")).first()[0]
    assert a == pytest.approx(b)


def test_early_stopping_keeps_the_errors_of_every_round(spark, fixture):
    """Boosting ends ``patience`` rounds after the best one; errors and best round are those of a fit without a stop."""
    r, users, items, V, ids, tv = fixture
    rows = FE.feature_rows(tv.select("user_id", "item_id", "stars", "split"), users, items)
    train, val = rows.where("split = 'train'"), rows.where("split = 'val'")
    p = MO.GBTParams(rounds=6, max_depth=3)
    m, b, errs = MO.fit_gbt_early_stopping(train, val, p, patience=2, with_embedding=False)
    _, whole_best, whole = MO.fit_gbt_early_stopping(train, val, p, patience=6, with_embedding=False)
    assert len(whole) == 6 and len(errs) == min(6, b + 2) and errs == whole[:len(errs)]
    assert b == TU.best_round(whole, 2) and 1 <= whole_best <= 6
    assert m.rounds == b


def test_pca_embedding(spark, fixture):
    r, users, items, V, ids, tv = fixture
    e = EM.embed_pca(tv, ids, V, k=4)
    assert e.columns == ["item_id", "e0", "e1", "e2", "e3"]
    assert e.count() == tv.select("item_id").distinct().count()


def test_a_fit_is_shared_until_its_tables_change(spark, tmp_path):
    from tastebud.plans import catalog

    made: list[int] = []

    def once() -> int:
        return catalog._once("shared", spark, str(tmp_path), lambda: made.append(1) or len(made))

    spark.range(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert once() == once() == 1
    spark.range(4).write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    assert once() == once() == 2
