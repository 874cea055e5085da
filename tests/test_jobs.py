"""File-to-file jobs on tiny inputs: layout, target order, routes."""

import glob
import json
import os

from tastebud import jobs


def _w(p, text):
    with open(p, "w") as f:
        f.write(text)


def _lines(out):
    text = ""
    for part in sorted(glob.glob(os.path.join(out, "part-*"))):
        text += open(part).read()
    return text.splitlines()


def _folder(d):
    _w(os.path.join(d, "train.csv"), "user_id,business_id,stars\n" + "".join(
        f"u{u},b{b},{(u * 7 + b * 3) % 5 + 1}.0\n" for u in range(12) for b in range(10) if (u + b) % 3))
    _w(os.path.join(d, "val.csv"), "user_id,business_id,stars\n" + "".join(
        f"u{u},b{b},{(u + b) % 5 + 1}.0\n" for u in range(12) for b in range(10) if (u + b) % 3 == 0 and u % 2))
    _w(os.path.join(d, "items.json"), "".join(json.dumps(
        {"business_id": f"b{b}", "stars": 3.0 + b % 3 * 0.5, "review_count": b + 1, "is_open": b % 2,
         "categories": None if b == 4 else ", ".join(["Food", "Bars", "Cafe"][: 1 + b % 3])}) + "\n"
        for b in range(10)))
    _w(os.path.join(d, "users.json"), "".join(json.dumps(
        {"user_id": f"u{u}", "review_count": u, "average_stars": 2.5 + u % 4 * 0.5, "useful": u,
         "funny": 0, "cool": 1, "fans": u % 2}) + "\n" for u in range(11)))
    _w(os.path.join(d, "test.csv"), "user_id,business_id,stars\nu3,b5,1\nzz,b1,2\nu1,b0,3\nu2,qq,4\nzz,qq,5\n")


def test_cf_job_keeps_target_order(spark, tmpdir_fresh):
    _folder(tmpdir_fresh)
    out = os.path.join(tmpdir_fresh, "cf_out")
    jobs.cf_job(spark, os.path.join(tmpdir_fresh, "train.csv"),
                os.path.join(tmpdir_fresh, "test.csv"), out)
    lines = _lines(out)
    assert lines[0] == "user_id, business_id, prediction"
    assert [ln.split(",")[:2] for ln in lines[1:]] == [["u3", "b5"], ["zz", "b1"], ["u1", "b0"],
                                                       ["u2", "qq"], ["zz", "qq"]]
    assert lines[2].split(",")[2] == "3.75" and lines[5].split(",")[2] == "3.75"


def test_model_and_hybrid_jobs(spark, tmpdir_fresh):
    _folder(tmpdir_fresh)
    for kind in ("model", "hybrid"):
        out = os.path.join(tmpdir_fresh, kind)
        jobs.model_job(spark, tmpdir_fresh, os.path.join(tmpdir_fresh, "test.csv"), out,
                       rounds=3, hybrid=kind == "hybrid")
        lines = _lines(out)
        assert len(lines) == 6
        got = {tuple(ln.split(",")[:2]): float(ln.split(",")[2]) for ln in lines[1:]}
        assert got[("zz", "qq")] == 3.75
        assert got[("zz", "b1")] == 3.5          # item-only route: the item's stars
        assert got[("u2", "qq")] == 3.5          # user-only route: the user's average
