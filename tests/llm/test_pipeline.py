"""The corpus pipeline against a brute-force version of each stage on the small tables."""

from __future__ import annotations

import zlib

import pytest
from test_operators import components, split

from tastebud.llm import mixing, quality, secrets
from tastebud.llm.common import table

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SMALL = "/root/testdata/sf0.001"


def test_stages_and_run_against_brute_force(spark):
    docs = [r.asDict() for r in table(spark, SMALL, "documents").collect()]
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SMALL, "labels").collect()}
    items = {r["item_id"]: split(r["text"]) for r in table(spark, SMALL, "benchmark").collect()}

    learn = [(d["text"].encode(), labels[d["doc_id"]]) for d in docs if d["doc_id"] in labels and zlib.crc32(str(d["doc_id"]).encode()) % 3 != 1]
    bad = sum(y == 0 for _, y in learn)
    assert 0 < bad < len(learn) < 3000
    # the classifier itself is fitted on an ordered sample: take the stage's rows, and check them against all labels
    kept = {r["doc_id"] for r in corpus_pipeline.STAGES[0][1](spark, table(spark, SMALL, "documents"), SMALL).collect()}
    assert all((i in kept) == (y == 1) for i, y in labels.items())
    docs = [d for d in docs if d["doc_id"] in kept]
    low = {i: c for i, _, c in components([(d["doc_id"], d["text"]) for d in docs], 5, 80)}
    docs = [d for d in docs if low[d["doc_id"]] == d["doc_id"]]

    def leaks(text: str) -> bool:
        line = " " + " ".join(split(text)) + " "
        return any(" " + " ".join(words) + " " in line for words in items.values())

    docs = [d for d in docs if not leaks(d["text"])]
    got = {r["doc_id"]: r.asDict() for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) <= {d["doc_id"] for d in docs}
    sizes, counts = {}, {}
    for d in docs:
        spans, text, end = secrets.base_spans(d["text"]), "", 0
        for _, a, z in spans:
            if a >= end:
                text += d["text"][end:a] + "[SECRET]"
            end = max(end, z)
        d["clean"] = text + d["text"][end:]
        counts[d["doc_id"]] = len(split(d["clean"]))
        sizes[d["source"]] = sizes.get(d["source"], 0) + counts[d["doc_id"]]
    goal = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)), sum(sizes.values()))
    for d in docs:
        r = got.get(d["doc_id"])
        if r is None:       # left out by the mix: its source's target is below its size
            assert goal[d["source"]] < sizes[d["source"]]
            continue
        assert (r["text"], r["n_chars"], r["lang"], r["size"]) == (d["clean"], len(d["clean"]), d["lang"], counts[d["doc_id"]])
        assert r["source_size"] == sizes[d["source"]] and abs(r["target"] - goal[d["source"]]) < 1e-6 and 0 < r["taken"] <= 3 * r["size"]
    for s in sizes:
        longest = max(counts[d["doc_id"]] for d in docs if d["source"] == s)
        assert abs(sum(r["taken"] for r in got.values() if r["source"] == s) - goal[s]) <= longest


def test_one_of_each_group_stays_at_five_words_and_four_fifths(spark):
    """Copies edited to a similarity of 0.8 to 0.85 go; repeated rows leave one row for each text, rows without id one."""
    base = [f"w{i}" for i in range(104)]
    near, far = list(base), list(base)
    near[50] = near[80] = "x"              # 90 of 110 shingles shared
    for i in (20, 50, 80):
        far[i] = "y"                       # 85 of 115
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, "one two three"), (4, "one two three"), (5, ""), (5, None), (None, "alone here")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, _rows string")
    got = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SMALL).collect()), key=str)
    assert got == sorted([rows[0], rows[2], rows[3], rows[5], rows[6], rows[7]], key=str)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SMALL, "documents")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "secrets", "mixture"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(40), SMALL).columns == docs.columns
    assert quality.BITS <= 20


def test_mixture_keeps_texts_without_words_by_their_copies(spark):
    line = "one two three four five"
    rows = [(k, line, source) for source, first in (("a", 0), ("b", 100), ("c", 200)) for k in range(first, first + 20)]
    none = [(first + 50 + i, text, source) for source, first in (("b", 100), ("c", 200)) for i, text in enumerate((None, "", " \t"))]
    docs = spark.createDataFrame(rows + none, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in corpus_pipeline.mixture(spark, docs, SMALL).collect()}
    # targets are 50, 100 and 150 of 100 words each: every row of b and c is taken once or more, half of a's
    assert {i for i in got if i >= 100} == {i for i, _, s in rows + none if s != "a"}
    assert all(got[i]["taken"] == 0 for i, _, _ in none) and sum(i < 100 for i in got) == 10
    assert got[100].asDict().keys() == {"doc_id", "text", "source", "size", "source_size", "target", "taken"}
