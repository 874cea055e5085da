"""CF: hand-made cases per rule and a brute-force check on the sf0.001 tables."""

import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tastebud.operators import cf as CF
from tastebud.sources import fixtures as FX


def _df(spark, rows):
    return spark.createDataFrame(rows, "user_id string, item_id string, stars double")


def _targets(spark, pairs):
    return spark.createDataFrame(pairs, "user_id string, item_id string")


def _predict(spark, train, targets, n=30, **kw):
    out = CF.cf_predict(_df(spark, train), _targets(spark, targets), n=n, decimals=None, **kw)
    return {(r.user_id, r.item_id): (r.prediction, r.n_neighbours, r.route) for r in out.collect()}


# --------------------------------------------------------------- brute force
def brute_cf(train, targets, n=30):
    """Direct dictionary implementation of the rule in SURVEY §7.3."""
    best, rows_of = {}, defaultdict(list)
    for u, i, s in train:
        best[(u, i)] = max(best.get((u, i), -math.inf), s)
        rows_of[u].append(s)
    umean = {u: sum(v) / len(v) for u, v in rows_of.items()}
    raters, hist = defaultdict(dict), defaultdict(dict)
    for (u, i), s in best.items():
        raters[i][u] = s
        hist[u][i] = s
    imean = {i: sum(d.values()) / len(d) for i, d in raters.items()}

    def weight(i, j):
        co = raters[i].keys() & raters[j].keys()
        k = len(co)
        if k == 0:
            raw = 1 - abs(imean[i] - imean[j]) / 5
            return raw if raw > 0.8 else None
        close = sum(1 - abs(raters[i][v] - raters[j][v]) / 5 for v in co) / k
        if k <= 2:
            return close if close > (0.6 if k == 1 else 0.7) else None
        xy = sum((raters[i][v] - imean[i]) * (raters[j][v] - imean[j]) for v in co)
        xx = sum((raters[i][v] - imean[i]) ** 2 for v in co)
        yy = sum((raters[j][v] - imean[j]) ** 2 for v in co)
        raw = close if (math.sqrt(xx) == 0 or math.sqrt(yy) == 0) else xy / (math.sqrt(xx) * math.sqrt(yy))
        return raw if raw >= 0.1 else None

    out = {}
    for u, b in targets:
        if u not in umean:
            out[(u, b)] = (3.75, 0)
        elif b not in raters:
            out[(u, b)] = (umean[u], 0)
        else:
            cands = []
            for j, r in hist[u].items():
                raw = weight(b, j)
                if raw is not None:
                    cands.append((-round(raw, 9), j, raw * abs(raw) ** 1.5, r))
            cands.sort()
            top = cands[:n]
            den = sum(abs(c[2]) for c in top)
            out[(u, b)] = ((sum(c[2] * c[3] for c in top) / den) if den else umean[u], len(top))
    return out


def test_cf_matches_brute_force_on_fixture(spark):
    r = FX.ratings(spark, SF001)
    train = [(x.user_id, x.item_id, x.stars) for x in
             FX.split_ratings(r, "train").collect()]
    targets = [(x.user_id, x.item_id) for x in FX.targets(r).select("user_id", "item_id").collect()]
    exp = brute_cf(train, targets)
    got = CF.cf_predict(FX.split_ratings(r, "train"), FX.targets(r), decimals=None).collect()
    assert len(got) == len(exp)
    bad = 0
    for g in got:
        e_pred, e_n = exp[(g.user_id, g.item_id)]
        if g.n_neighbours != e_n or abs(g.prediction - e_pred) > 1e-9:
            bad += 1
    assert bad == 0


# --------------------------------------------------------------- hand cases
def test_cold_routes(spark):
    train = [("u1", "a", 4.0), ("u1", "b", 2.0), ("u2", "a", 5.0)]
    p = _predict(spark, train, [("zz", "a"), ("zz", "qq"), ("u1", "qq")])
    assert p[("zz", "a")][0] == 3.75 and p[("zz", "a")][2] == "item_only"
    assert p[("zz", "qq")][0] == 3.75 and p[("zz", "qq")][2] == "neither"
    assert p[("u1", "qq")][0] == pytest.approx(3.0) and p[("u1", "qq")][2] == "user_only"


def test_user_mean_counts_duplicate_rows(spark):
    # raw rows: 5, 5, 2 -> mean 4; dedup would give (5 + 2)/2
    train = [("u1", "a", 5.0), ("u1", "a", 5.0), ("u1", "b", 2.0)]
    p = _predict(spark, train, [("u1", "new")])
    assert p[("u1", "new")][0] == pytest.approx(4.0)


def test_n0_threshold_is_strict(spark):
    # items a (mean 4) and b (mean 5): no co-raters, closeness 0.8 -> dropped;
    # the target falls back to the user mean
    train = [("u1", "a", 4.0), ("u2", "b", 5.0)]
    p = _predict(spark, train, [("u1", "b")])
    assert p[("u1", "b")][1] == 0
    assert p[("u1", "b")][0] == pytest.approx(4.0)


def test_n0_kept_above_threshold(spark):
    # means 4 and 4.5: closeness 0.9 -> kept, prediction = the neighbour's rating
    train = [("u1", "a", 4.0), ("u2", "b", 4.0), ("u3", "b", 5.0)]
    p = _predict(spark, train, [("u1", "b")])
    assert p[("u1", "b")][1] == 1
    assert p[("u1", "b")][0] == pytest.approx(4.0)


def test_n1_threshold(spark):
    # co-rater u2 rates a=5, b=3: closeness 1 - 2/5 = 0.6 -> dropped
    train = [("u1", "a", 5.0), ("u2", "a", 5.0), ("u2", "b", 3.0)]
    assert _predict(spark, train, [("u1", "b")])[("u1", "b")][1] == 0
    # a=5, b=4: 0.8 -> kept
    train = [("u1", "a", 5.0), ("u2", "a", 5.0), ("u2", "b", 4.0)]
    assert _predict(spark, train, [("u1", "b")])[("u1", "b")][1] == 1


def test_n2_threshold(spark):
    # two co-raters with closeness 0.8 and 0.6: mean as computed in doubles
    train = [("u1", "a", 5.0), ("u2", "a", 5.0), ("u2", "b", 4.0),
             ("u3", "a", 5.0), ("u3", "b", 3.0)]
    w = ((1 - 1 / 5) + (1 - 2 / 5)) / 2
    kept = _predict(spark, train, [("u1", "b")])[("u1", "b")][1] == 1
    assert kept == (w > 0.7)


def test_pearson_zero_norm_fallback(spark):
    # item a has all ratings 3 (centred norm 0) -> mean closeness is used
    train = [("u1", "a", 3.0), ("u2", "a", 3.0), ("u3", "a", 3.0), ("u4", "a", 3.0),
             ("u2", "b", 3.0), ("u3", "b", 4.0), ("u4", "b", 3.0)]
    parts = CF.cf_parts(_df(spark, train), _targets(spark, [("u1", "b")]))
    st = parts.stats.collect()
    assert len(st) == 1 and st[0].n_co == 3 and st[0].ss_i == 0.0
    w = parts.weights.collect()
    assert len(w) == 1
    assert w[0].raw_w == pytest.approx((1 + 0.8 + 1) / 3)


def test_top_n_ties_broken_by_neighbour_id(spark):
    # target (u1, t): neighbours x, y, z all with closeness-of-means 1.0
    train = [("u1", "x", 2.0), ("u1", "y", 4.0), ("u1", "z", 5.0),
             ("u9", "t", 3.0), ("u8", "x", 3.0), ("u8", "y", 3.0), ("u8", "z", 3.0)]
    # means: t=3, x=2.5, y=3.5, z=4 -> closeness 0.9, 0.9, 0.8(dropped)
    p = _predict(spark, train, [("u1", "t")], n=1)
    assert p[("u1", "t")][1] == 1
    assert p[("u1", "t")][0] == pytest.approx(2.0)   # x wins the tie over y


def test_self_neighbour_kept_and_excludable(spark):
    train = [("u1", "a", 4.0), ("u1", "b", 2.0), ("u2", "a", 4.0), ("u2", "b", 2.0)]
    p = _predict(spark, train, [("u1", "a")])
    assert p[("u1", "a")][1] == 1         # a itself (closeness 1); b has 0.6 -> dropped
    q = _predict(spark, train, [("u1", "a")], exclude_self=True)
    assert q[("u1", "a")][1] == 0


def test_prediction_within_user_range_and_partition_invariant(spark):
    r = FX.ratings(spark, SF001)
    train = FX.split_ratings(r, "train")
    a = CF.cf_predict(train, FX.targets(r)).where(F.col("n_neighbours") > 0)
    lo_hi = train.groupBy("user_id").agg(F.min("stars").alias("lo"), F.max("stars").alias("hi"))
    out = a.join(lo_hi, "user_id").where((F.col("prediction") < F.col("lo") - 1e-9) |
                                         (F.col("prediction") > F.col("hi") + 1e-9))
    assert out.count() == 0
    b = CF.cf_predict(train.repartition(3), FX.targets(r).repartition(5))
    key = ["user_id", "item_id", "prediction", "n_neighbours"]
    assert a.select(key).exceptAll(b.where(F.col("n_neighbours") > 0).select(key)).count() == 0


def test_pair_weight_symmetric(spark):
    from tastebud.operators import similarity as SIM
    train = [("u1", "a", 4.0), ("u1", "b", 5.0), ("u2", "a", 3.0), ("u2", "b", 4.0),
             ("u3", "a", 5.0), ("u3", "b", 2.0), ("u4", "b", 1.0), ("u5", "a", 2.0)]

    def raw(target):
        parts = CF.cf_parts(_df(spark, train), _targets(spark, [target]))
        w = SIM.pair_weights(parts.stats, kept_only=False).collect()
        return {(x.item_i, x.item_j): x.raw_w for x in w}

    # (u4, a) sees the pair through b; (u5, b) sees it through a
    assert raw(("u4", "a"))[("a", "b")] == pytest.approx(raw(("u5", "b"))[("a", "b")])
