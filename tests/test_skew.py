"""Hot keys: one user and one item each hold about a third of all ratings.

Hot keys are cut by ``blocked_join``; AQE's thresholds are lowered too, so that its split of other joins runs; the
result must equal the brute-force rule.
"""

import random

from test_cf import brute_cf
from tastebud.operators import cf as CF


def test_hot_user_and_item_match_brute_force(spark):
    rnd = random.Random(5)
    rows = []
    users = [f"u{k}" for k in range(60)]
    items = [f"i{k}" for k in range(80)]
    for it in items:                                   # hot user rates everything
        rows.append(("hot", it, float(rnd.randint(1, 5))))
    for u in users:                                    # everyone rates the hot item
        rows.append((u, "ihot", float(rnd.randint(1, 5))))
    for _ in range(100):
        rows.append((rnd.choice(users), rnd.choice(items), float(rnd.randint(1, 5))))
    rows.append(("hot", "ihot", 4.0))
    targets = sorted({("hot", rnd.choice(items + ["new"])) for _ in range(30)} |
                     {(rnd.choice(users), "ihot") for _ in range(20)} |
                     {(rnd.choice(users), rnd.choice(items)) for _ in range(20)})
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        train = spark.createDataFrame(rows, "user_id string, item_id string, stars double")
        tg = spark.createDataFrame(targets, "user_id string, item_id string")
        got = {(r.user_id, r.item_id): (r.prediction, r.n_neighbours)
               for r in CF.cf_predict(train, tg, decimals=None).collect()}
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    exp = brute_cf(rows, targets)
    assert set(got) == set(exp)
    for k, (p, n) in exp.items():
        assert got[k][1] == n and abs(got[k][0] - p) < 1e-9, k
