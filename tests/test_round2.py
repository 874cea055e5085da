"""Hot keys, what a query writes, released tables, file jobs, strict readers, session settings, stable fits."""

import glob
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tastebud import jobs
from tastebud import session as SE
from tastebud.operators import cf as CF
from tastebud.operators import model as MO
from tastebud.operators import similarity as SIM
from tastebud.sources import readers, sinks

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _rows_per_task(df):
    return [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]


def _hot(spark):
    left = spark.range(900).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("a")).unionByName(
        spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 10_000).alias("a")))
    right = spark.range(2900).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("b")).unionByName(
        spark.range(100).select(F.col("id").alias("k"), (F.col("id") + 10_000).alias("b")))
    return left, right


def test_hot_key_is_spread_and_whole(spark):
    left, right = _hot(spark)
    got = SIM.blocked_join(left, right, "k", "a", "b", rows=128)
    plain = left.join(right, "k")
    assert got.count() == got.distinct().count() == plain.count()
    assert got.exceptAll(plain).isEmpty()
    per_task = _rows_per_task(got)
    assert len(per_task) > 4 and max(per_task) < 0.45 * sum(per_task)


def test_hot_user_and_hot_drive_item_match_plain_join(spark):
    ratings = spark.range(3000).select(F.lit(1).cast("long").alias("user_id"), F.col("id").alias("item_id"), F.lit(3.0).alias("stars"))
    targets = spark.range(3000, 3700).select(F.lit(1).cast("long").alias("user_id"), F.col("id").alias("item_id"))
    got = SIM.candidate_neighbours(targets, ratings)
    assert got.count() == 700 * 3000
    assert max(_rows_per_task(got)) < 0.6 * 700 * 3000


def _written_by(run):
    first = len(SE._written)
    run()
    return {os.path.basename(p).rsplit("-", 1)[0] for p in SE._written[first:]}


def test_light_stages_never_write_the_pair_table(spark):
    train = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(8) for i in range(6) if (u + i) % 3], "user_id long, item_id long, stars double")
    targets = spark.createDataFrame([(u, i) for u in range(9) for i in range(7) if (u + i) % 3 == 0], "user_id long, item_id long")
    parts = CF.cf_parts(train, targets)
    assert "cf_pairs" not in _written_by(lambda: (parts.routed.count(), parts.candidates.count(), parts.pairs.count()))
    assert "cf_pairs" in _written_by(lambda: parts.stats.count())


def test_released_tables_are_removed(spark):
    before = len(SE._written)
    with SE.released(spark):
        assert SE.materialize(spark.range(5), "gone").count() == 5
        path = SE._written[-1].removeprefix("file:")
        assert os.path.isdir(path)
    assert not os.path.exists(path) and len(SE._written) == before


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def _lines(out):
    return "".join(open(p).read() for p in sorted(glob.glob(os.path.join(out, "part-*")))).splitlines()


def test_cf_job_empty_ids_duplicates_and_several_files(spark, tmpdir_fresh):
    d = tmpdir_fresh
    _write(os.path.join(d, "train.csv"), "u,b,stars,date\n" + "".join(f"u{u},b{b},{(u + b) % 5 + 1}.0,x\n" for u in range(6) for b in range(6) if u != b))
    os.mkdir(os.path.join(d, "targets"))
    first = ["u1,b1"]
    second = [",a", "u9,", ",", "u2,b2", "u2,b2"] + [f"u{k % 6},b{k % 7}" for k in range(200)]
    _write(os.path.join(d, "targets", "a.csv"), "u,b\n" + "\n".join(first) + "\n")
    _write(os.path.join(d, "targets", "b.csv"), "u,b\n" + "\n".join(second) + "\n")
    out = os.path.join(d, "out")
    jobs.cf_job(spark, os.path.join(d, "train.csv"), os.path.join(d, "targets"), out)
    lines = _lines(out)
    assert [x.rsplit(",", 1)[0] for x in lines[1:]] == first + second
    assert lines.count(sinks.PREDICTION_HEADER) == 1 and lines[0] == sinks.PREDICTION_HEADER
    assert lines[2:5] == [",a,3.75", "u9,,3.75", ",,3.75"] and all(x.rsplit(",", 1)[1] for x in lines[1:])


def test_lines_are_written_as_they_are(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "o")
    df = spark.createDataFrame([('a"b', "c\td", 1.5), (None, "x", None)], "user_id string, item_id string, prediction double")
    sinks.write_predictions(df.coalesce(1), out)
    assert sorted(_lines(out)) == sorted([sinks.PREDICTION_HEADER, 'a"b,c\td,1.5', ",x,"])


def test_readers_are_strict(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "x")
    _write(p, json.dumps({"business_id": "b", "stars": 3.5}) + "\n{broken\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_items(spark, p).collect()
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_users(spark, p).collect()
    _write(p, "a,b\n1.0,oops\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        readers.read_matrix(spark, p, ["a", "b"]).collect()
    _write(p, "u,b,s,more\nu1,b1,4.0,z\nu2,b2,,z\n")
    assert [tuple(r) for r in readers.read_ratings(spark, p).collect()] == [("u1", "b1", 4.0), ("u2", "b2", None)]
    _write(p, "u,b,s\nu1,b1,four\n")
    with pytest.raises(Exception, match="not a number"):
        readers.read_ratings(spark, p).collect()


def test_fitted_trees_do_not_depend_on_input_partitions(spark):
    cols = MO.feature_columns(False)
    rows = spark.range(600).select(
        F.col("id").alias("user_id"), (F.col("id") % 37).alias("item_id"), (F.col("id") % 5 + 1.0).alias("stars"),
        *[((F.col("id") * (k + 3)) % 17).cast("double").alias(c) for k, c in enumerate(cols)])
    p = MO.GBTParams(rounds=4, max_depth=3)
    scores = [MO.score(MO.fit_gbt(rows.repartition(n), p, False), rows, False).agg(F.sum(F.round("model_score", 9))).first()[0] for n in (4, 8)]
    assert scores[0] == pytest.approx(scores[1], abs=1e-9)


def test_launch_settings_win(tmpdir_fresh):
    code = ("import sys; sys.path.insert(0, %r)\n"
            "from tastebud.session import build_session\n"
            "s = build_session('local[1]')\n"
            "print('GOT', s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.skewJoin.enabled'))\n" % ROOT)
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": "--conf spark.sql.session.timeZone=Asia/Tokyo --conf spark.sql.adaptive.skewJoin.enabled=false pyspark-shell"}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120).stdout
    assert "GOT Asia/Tokyo false" in out
