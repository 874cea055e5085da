"""Property checks on random small rating sets (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from test_cf import brute_cf
from tastebud.operators import cf as CF

users = st.sampled_from([f"u{k}" for k in range(6)])
items = st.sampled_from([f"i{k}" for k in range(7)])
stars = st.sampled_from([1.0, 2.0, 3.0, 4.0, 5.0])
ratings = st.lists(st.tuples(users, items, stars), min_size=1, max_size=40)
targets = st.lists(st.tuples(st.sampled_from([f"u{k}" for k in range(8)]),
                             st.sampled_from([f"i{k}" for k in range(9)])),
                   min_size=1, max_size=12, unique=True)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ratings, tg=targets, n=st.sampled_from([1, 2, 30]))
def test_cf_equals_brute_force(spark, rows, tg, n):
    train = spark.createDataFrame(rows, "user_id string, item_id string, stars double")
    t = spark.createDataFrame(tg, "user_id string, item_id string")
    got = {(r.user_id, r.item_id): (r.prediction, r.n_neighbours)
           for r in CF.cf_predict(train, t, n=n, decimals=None, prepared=None).collect()}
    exp = brute_cf(rows, tg, n)
    assert set(got) == set(exp)
    for k, (p, c) in exp.items():
        assert got[k][1] == c
        assert abs(got[k][0] - p) < 1e-9
        if c:       # neighbour predictions lie within the user's rating range
            mine = [s for u, _, s in rows if u == k[0]]
            assert min(mine) - 1e-9 <= got[k][0] <= max(mine) + 1e-9
