"""CF figures measured independently on the fixture (FIXTURES.md §3)."""

import pytest
from pyspark.sql import functions as F

from tastebud.operators import cf as CF
from tastebud.operators import evaluate as EV
from tastebud.operators import similarity as SIM
from tastebud.sources import fixtures as FX

# sf: rmse, candidate rows, distinct pairs, kept/dropped per co-rater branch
# (0, 1, 2, >=3), self-neighbours kept, targets with 30 neighbours
FIGURES = {
    "sf0.001": (1.616682, 27934, 14499,
                {0: (834, 62), 1: (1253, 1181), 2: (1287, 2230), 3: (3346, 4306)}, 143, 1),
    "sf0.01": (1.480246, 292664, 270405,
               {0: (189126, 5876), 1: (32923, 30643), 2: (3786, 6663), 3: (681, 707)}, 136, 2370),
}


@pytest.mark.parametrize("sf", sorted(FIGURES))
def test_cf_figures(spark, sf):
    rmse, n_cand, n_pairs, branches, n_self, n_full = FIGURES[sf]
    r = FX.ratings(spark, f"/root/testdata/{sf}")
    p = CF.cf_parts(FX.split_ratings(r, "train"), FX.targets(r))
    pred = CF.predict(p)
    assert EV.rmse(pred).first().rmse == rmse
    assert p.candidates.count() == n_cand and p.pairs.count() == n_pairs
    w = SIM.pair_weights(p.stats, kept_only=False)
    got = {(x.b, x.keep): x["count"] for x in
           w.groupBy(F.least("n_co", F.lit(3)).alias("b"), "keep").count().collect()}
    for b, (kept, dropped) in branches.items():
        assert (got.get((b, True), 0), got.get((b, False), 0)) == (kept, dropped)
    assert p.top.where(F.col("item_id") == F.col("neighbour_id")).count() == n_self
    assert pred.where(F.col("n_neighbours") == 30).count() == n_full


ROUTES = {
    # neither / item only / user only / both
    "sf0.001": {"cf": (4, 196, 169, 1084), "model": (3, 166, 119, 1165)},
    "sf0.01": {"cf": (103, 2108, 1840, 10942), "model": (41, 1556, 1434, 11962)},
    "sf0.1": {"cf": (1033, 21467, 18497, 109874), "model": (389, 16382, 14037, 120063)},
}


@pytest.mark.parametrize("sf", sorted(ROUTES))
def test_route_figures(spark, sf):
    from tastebud.plans import catalog
    d = f"/root/testdata/{sf}"
    for kind in ("cf", "model"):
        got = {x.route: x.n for x in catalog.QUERIES[f"{kind}_routes"](spark, d).collect()}
        assert tuple(got.get(k, 0) for k in ("neither", "item_only", "user_only", "both")) == ROUTES[sf][kind]


PROFILES = {
    # null / empty categories; train+val rows: no user profile only, no item profile only, neither
    "sf0.001": ((11, 10), (175, 97, 6)),
    "sf0.01": ((115, 97), (1592, 1029, 44)),
}


@pytest.mark.parametrize("sf", sorted(PROFILES))
def test_profile_figures(spark, sf):
    from tastebud.plans import catalog
    d = f"/root/testdata/{sf}"
    cats, rows = PROFILES[sf]
    items = catalog.QUERIES["item_profiles"](spark, d)
    assert (items.where(F.col("categories").isNull()).count(),
            items.where(F.col("categories") == "").count()) == cats
    fr = catalog.QUERIES["feature_rows"](spark, d)
    nu, ni = F.col("average_stars").isNull(), F.col("item_stars").isNull()
    got = fr.agg(F.count(F.when(nu & ~ni, 1)).alias("u"), F.count(F.when(ni & ~nu, 1)).alias("i"),
                 F.count(F.when(nu & ni, 1)).alias("b")).first()
    assert (got.u, got.i, got.b) == rows


@pytest.mark.parametrize("sf,expected", [("sf0.001", 81), ("sf0.01", 1020)])
def test_model_known_but_cf_cold(spark, sf, expected):
    """Targets known in train ∪ val but cold for CF (trained on train only):
    the hybrid scores them with the CF scalar, 0 neighbours, alpha 0.05."""
    from tastebud.plans import catalog
    hb = catalog.QUERIES["hybrid_blend"](spark, f"/root/testdata/{sf}")
    r = FX.ratings(spark, f"/root/testdata/{sf}")
    cf_routes = CF.cf_parts(FX.split_ratings(r, "train"), FX.targets(r)).routed.select(
        "user_id", "item_id", F.col("route").alias("cf_route"))
    j = hb.join(cf_routes, ["user_id", "item_id"]).where((F.col("route") == "both") &
                                                         (F.col("cf_route") != "both"))
    assert j.count() == expected
    assert j.where((F.col("alpha") != 0.05) | (F.col("n_neighbours") != 0)).count() == 0
