"""Lines of many files cut into splits: headers, positions, splits at a row, zips."""

import os

import pytest
from pyspark.sql import functions as F

from tastebud.operators import features as FE
from tastebud.sources import lines as LI
from tastebud.sources import readers

HEAD = "user_id,business_id,stars"


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 100 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write(folder, name, text):
    with open(os.path.join(folder, name), "w", newline="") as f:
        f.write(text)


def data(first, last):
    return [f"u{k % 7},b{k},{k % 5 + 1}.0" for k in range(first, last)]


@pytest.mark.parametrize("most", [LI.MOST_FILES, 0])
def test_positions_and_headers_over_files_and_splits(spark, tmp_path, small_splits, monkeypatch, most):
    """Also where headers meet the lines in a shuffle."""
    monkeypatch.setattr(LI, "MOST_FILES", most)
    a, b = data(0, 60), data(60, 75)
    write(tmp_path, "a.csv", "\n".join([HEAD, *a[:20], HEAD, *a[20:40], "", HEAD, HEAD, *a[40:]]))
    write(tmp_path, "b.csv", "")
    write(tmp_path, "c.csv", "\r\n".join(["u,b,s", *b, HEAD.replace("stars", "9"), "u,b,s", ""]))
    rows = LI.positioned(readers.read_ratings(spark, str(tmp_path), place=True))
    got = rows.orderBy("position").collect()
    want = [x.split(",") for x in a + b + [HEAD.replace("stars", "9")]]
    assert [r["position"] for r in got] == list(range(len(want)))
    assert [[r["user_id"], r["item_id"], r["stars"]] for r in got] == [[u, i, float(s)] for u, i, s in want]
    assert len({(r["file"], r["block"]) for r in got}) > 8
    parts = {r["item_id"]: r["split"] for r in LI.split_at(rows, 62).collect()}
    assert [parts[w[1]] for w in want] == ["train"] * 62 + ["val"] * (len(want) - 62)
    first = {r["user_id"]: r["first_item_id"] for r in FE.first_occurrence(rows, "user_id", "position").collect()}
    assert first == {u: i for u, i, _ in reversed(want)}


def test_bad_number_stops_the_job_in_any_split(spark, tmp_path, small_splits):
    write(tmp_path, "a.csv", "\n".join([HEAD, *data(0, 50), "u1,b1,four", *data(50, 60)]))
    with pytest.raises(Exception, match="not a number"):
        readers.read_ratings(spark, str(tmp_path)).collect()
    assert readers.read_targets(spark, str(tmp_path)).count() == 61


def test_quotes_are_not_special_and_lacking_fields_are_empty(spark, tmp_path):
    write(tmp_path, "a.csv", 'u,b\n"x,y"\nonly\n,\n')
    assert [tuple(r) for r in readers.read_targets(spark, str(tmp_path)).collect()] == [('"x', 'y"'), ("only", ""), ("", "")]


def test_zip_of_two_files(spark, tmp_path, small_splits):
    os.mkdir(tmp_path / "l")
    os.mkdir(tmp_path / "r")
    rows = data(0, 80)
    write(tmp_path / "l", "x.csv", "\n".join(["h", *rows]))
    write(tmp_path / "r", "y0.csv", "\n".join(["stars", *[x.split(",")[2] for x in rows[:30]]]))
    write(tmp_path / "r", "y1.csv", "\n".join(["stars", *[x.split(",")[2] for x in rows[30:]]]))
    left = LI.positioned(readers.read_targets(spark, str(tmp_path / "l"), place=True))
    right = LI.positioned(LI.read_rows(spark, str(tmp_path / "r"))).withColumn("s", F.col("value"))
    got = LI.zipped(left, right).orderBy("position").collect()
    assert [f"{r['user_id']},{r['item_id']},{r['s']}" for r in got] == rows
    with pytest.raises(ValueError, match="cannot be zipped"):
        LI.zipped(left, right.where("position > 3"))


def test_running_sum_is_that_of_one_sorted_pass(spark):
    df = spark.range(500).select(((F.col("id") * 7919) % 500).alias("k"), (F.col("id") % 13).alias("n"))
    got = {r["k"]: r["before"] for r in LI.running_sum(df, ["k"], "n", "before").collect()}
    total = 0
    for r in sorted(df.collect()):
        assert got[r["k"]] == total
        total += r["n"]
    assert LI.running_sum(df.limit(0), ["k"], "n", "before").count() == 0


def test_no_files_lines_or_headers(spark, tmp_path):
    write(tmp_path, "a.csv", "")
    assert LI.positioned(readers.read_ratings(spark, str(tmp_path), place=True)).count() == 0
