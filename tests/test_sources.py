"""File sources and sinks: CSV / JSON readers, prediction file layout."""

import glob
import json
import os

from tastebud.sources import readers, sinks


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_rating_and_target_csv(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "train.csv")
    _write(p, "user_id,business_id,stars\nu1,b1,4.0\nu2,b1,3.0\n")
    r = readers.read_ratings(spark, p).collect()
    assert [(x.user_id, x.item_id, x.stars) for x in r] == [("u1", "b1", 4.0), ("u2", "b1", 3.0)]
    t = os.path.join(tmpdir_fresh, "val.csv")
    _write(t, "user_id,business_id,stars\nu1,b2,5.0\n")
    got = readers.read_targets(spark, t).collect()
    assert [(x.user_id, x.item_id) for x in got] == [("u1", "b2")]


def test_profile_json(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "business.json")
    rows = [{"business_id": "b1", "stars": 4.5, "review_count": 10, "is_open": 1,
             "categories": "Food, Bars", "extra": "x"},
            {"business_id": "b2", "stars": 3.0, "review_count": 2, "is_open": 0, "categories": None}]
    _write(p, "\n".join(json.dumps(r) for r in rows) + "\n")
    items = readers.read_items(spark, p).orderBy("item_id").collect()
    assert items[0].item_id == "b1" and items[0].categories == "Food, Bars"
    assert items[1].categories is None
    u = os.path.join(tmpdir_fresh, "user.json")
    _write(u, json.dumps({"user_id": "u1", "review_count": 3, "average_stars": 3.5, "useful": 1,
                          "funny": 0, "cool": 2, "fans": 0, "name": "n"}) + "\n")
    assert readers.read_users(spark, u).first().average_stars == 3.5


def test_prediction_file_layout(spark, tmpdir_fresh):
    df = spark.createDataFrame([("u1", "b1", 3.5), ("u2", "b9", 4.25)],
                               "user_id string, item_id string, prediction double")
    out = os.path.join(tmpdir_fresh, "pred")
    sinks.write_predictions(df.coalesce(1), out, order_col="user_id")
    part = glob.glob(os.path.join(out, "part-*"))[0]
    lines = open(part).read().splitlines()
    assert lines[0] == sinks.PREDICTION_HEADER
    assert lines[1:] == ["u1,b1,3.5", "u2,b9,4.25"]


def test_matrix_csv(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "m.csv")
    _write(p, "1.0,2.5\n,3\n")
    rows = readers.read_matrix(spark, p, ["a", "b"], header=False).collect()
    assert rows[0].a == 1.0 and rows[1].a is None and rows[1].b == 3.0
