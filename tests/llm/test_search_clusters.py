"""Ranked search, centroid clustering and SimHash against brute force, and on odd tables."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pytest
import xxhash

from tastebud.llm import centroids, ranked, simhash

SYLLABLES = "an the on ing tion re ea st ed lo wei vi ou er le".split()
DOCS = "doc_id long, text string, fingerprint string, print long, n long, component_id long, score long, item_id long, rank int, terms string"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def table(spark, rows):
    """(doc_id, text) rows with further columns whose names clash with results and inner columns."""
    return spark.createDataFrame([(i, t, "x", 1, 2, 3, 4, 5, 6, "y") for i, t in rows], DOCS)


def odd_texts() -> list[tuple]:
    rng = random.Random(5)
    plain, long = " ".join(words(rng, 80)), " ".join(words(rng, 30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "x" * 50_000), (6, plain), (7, plain), (7, plain), (None, plain),
            (None, None), (8, "one two"), (9, "ONE  two"), (10, plain + " Ärger über Öl"), (11, "a-b_c.d 1,000 é É"), (12, "the")]


# ---------------------------------------------------------------- ranked search
def brute_top(docs, items, k=10):
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    held = [(i, collections.Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, occurrences = len(held), sum(c.total() for _, c in held)
    df = collections.Counter(t for _, c in held for t in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, ts in asked.items():
        rows = []
        for i, c in held:
            m = 100 - 90 + (90 * c.total() * n_docs) // occurrences
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in ts if c[t])
            if s > 0:
                rows.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, row[3], -row[0]) for r, row in enumerate(sorted(rows)[:k])]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("shard,block", [(ranked.SHARD, ranked.BLOCK_TERMS), (300, 40)])
def test_top_documents_match_brute_force(spark, monkeypatch, shard, block):
    """Also with shards of a few documents and items in many blocks."""
    monkeypatch.setattr(ranked, "SHARD", shard)
    monkeypatch.setattr(ranked, "BLOCK_TERMS", block)
    rng = random.Random(1)
    docs = [(i, " ".join(words(rng, rng.randint(1, 120)))) for i in range(150)] + odd_texts()
    docs += [(300 + i, docs[3][1]) for i in range(15)]                        # more ties than ranks
    items = [(i, " ".join(words(rng, 12))) for i in range(12)] + [(12, docs[3][1]), (13, None), (14, "zzzz qqqq"), (15, ""), (None, "the on"),
                                                                 (None, "ÄRGER Ärger"), (2, "weivi the")]
    got = ranked.top_documents(table(spark, docs).repartition(3), spark.createDataFrame([(i, t, "s") for i, t in items], "item_id long, text string, doc_id string"))
    assert found(got) == brute_top(docs, items)


def test_accumulators_stop_and_scores_stay_exact():
    """A rare term decides: the frequent terms' lists make no further accumulators."""
    import pyarrow as pa
    n = 400
    asked = ranked.Queries({b"a": 0, b"b": 1}, [1], [np.array([0, 1])])
    asked.documents, asked.occurrences = 1000, 20_000
    asked.df = np.array([12, 400])
    asked.weight = np.array([ranked.weight(1000, 12), ranked.weight(1000, 400)])
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(n), pa.int64()), pa.array([20] * n, pa.int64()), pa.array([[0, 1] if i % 32 == 0 else [1] for i in range(n)], pa.list_(pa.int32())),
         pa.array([[3, 1] if i % 32 == 0 else [1] for i in range(n)], pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tf"])
    shard = ranked.Shard([batch], asked)
    top, made = shard.best(asked.terms[0], 10)
    assert made == 13
    give = [int(shard.list_of(t)[1][0]) for t in (0, 1)]
    assert top == [(32 * i, sum(give)) for i in range(10)]


def test_document_size_needs_no_wrapping():
    """90 * n * N leaves 64 bits for a long text in a huge corpus; the size does not."""
    import pyarrow as pa
    asked = ranked.Queries({b"a": 0}, [1], [np.array([0])], np.array([5]), np.array([1]), 30_000_000_000, 9_000_000_000_000)
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array([50_000_000], pa.int64()), pa.array([[0]], pa.list_(pa.int32())),
                                        pa.array([[7]], pa.list_(pa.int64()))], ["doc_id", "n", "terms", "tf"])
    m = 10 + 90 * 50_000_000 * 30_000_000_000 // 9_000_000_000_000
    assert ranked.Shard([batch], asked).gives.tolist() == [5 * (7 * 10**9 // (7000 + 8 * m))]


def test_ranked_empty_tables(spark):
    docs, items = table(spark, []), spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranked.top_documents(docs, items).count() == 0
    assert ranked.top_documents(table(spark, odd_texts()), items.limit(0)).collect() == []


# ---------------------------------------------------------------- centroid clustering
def brute_clusters(rows, k=8, rounds=10, seed=3):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    drawn = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    cents = [v for _, v in drawn[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        groups = collections.defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        cents = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(cents)]
    last = [(i, *nearest(v)) for i, v in kept]
    inertia = collections.Counter()
    for _, d, j in last:
        inertia[j] += d
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest()) for i, d, j in last), key=str)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7, 8) for i, v in rows], "vec_id long, embedding array<float>, cluster int, distance long")


def clumps(n: int, noise: float) -> list[tuple]:
    rng = np.random.default_rng(4)
    middle = rng.normal(0, 1, (10, 64))
    return [(i, (middle[i % 10] + rng.normal(0, noise, 64)).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("noise", [0.1, 2.0])
def test_clusters_match_brute_force(spark, noise):
    rows = clumps(240, noise)
    rows += [(3, rows[3][1]), (None, rows[4][1]), (500, None), (501, [1.0] * 63), (502, [1.0] * 63 + [None]), (503, [float("nan")] * 64),
             (504, [float("inf")] + [0.0] * 63), (505, []), (506, [0.0] * 64), (507, [0.0] * 64), (508, [1000.0] * 64)]
    got = centroids.clustered(vectors(spark, rows).repartition(3))
    assert sorted(map(tuple, got.collect()), key=str) == brute_clusters(rows)


def test_ties_and_few_vectors(spark):
    same = [(i, [0.5] * 64) for i in range(5)]
    assert sorted(map(tuple, centroids.clustered(vectors(spark, same)).collect()), key=str) == brute_clusters(same)
    assert centroids.clustered(vectors(spark, [])).count() == 0
    assert centroids.clustered(vectors(spark, [(1, None)])).columns == centroids.clustered(vectors(spark, same)).columns
    with pytest.raises(ValueError):
        centroids.clustered(vectors(spark, [(1, [1e9] * 64)]))


def test_filter_spares_most_distances(spark):
    report: list = []
    centroids.clustered(vectors(spark, clumps(400, 0.1)), report=report)
    assert report and all(tried < 0.4 * whole for tried, whole in report)


@pytest.mark.parametrize("scale", [1, 2**25])
def test_bound_never_loses_the_nearest(scale):
    rng = np.random.default_rng(2)
    x = rng.integers(-scale, scale + 1, (500, 64))
    cents = x[rng.choice(500, 40)] + rng.integers(0, 2, (40, 64))
    ones = np.column_stack([x.astype(float), np.ones(500)])
    turn = centroids.Rotation.of(ones.T @ ones, 12)
    number, best, _ = centroids.nearest(x, turn(x.astype(float)), cents, turn(cents.astype(float)))
    whole = ((x[:, None, :] - cents[None]) ** 2).sum(-1)
    assert (number == whole.argmin(1)).all() and (best == whole.min(1)).all()


# ---------------------------------------------------------------- SimHash
def brute_print(text, width=4):
    ws = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    grams = [" ".join(ws[i:i + width]) for i in range(max(1, len(ws) - width + 1))] if ws else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, radius=4):
    prints = [brute_print(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    low: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return sorted(((d, f"{prints[i]:016x}", low.get(top(i))) for i, (d, _) in enumerate(rows)), key=str)


def near_texts(rng: random.Random) -> list[tuple]:
    rows = []
    for g in range(25):
        base = words(rng, 300)
        for c in range(8):
            text = list(base)
            for _ in range(c):
                text[rng.randrange(300)] = "edit"
            rows.append((1000 + 8 * g + c, " ".join(text)))
    return rows


@pytest.mark.parametrize("block", [simhash.BLOCK, 2])
def test_simhash_components_match_all_pairs(spark, monkeypatch, block):
    """Also where every bucket is cut into blocks of two."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = near_texts(random.Random(3)) + odd_texts()
    got = simhash.simhash_components(table(spark, rows).repartition(4), width=4, radius=4)
    want = brute_components(rows)
    assert sorted(map(tuple, got.select("doc_id", "fingerprint", "component_id").collect()), key=str) == want
    assert len({w[2] for w in want}) < len(rows) - 40


def test_every_pair_within_the_radius_meets_in_a_table():
    rng, masks = random.Random(9), simhash.covering_masks(4)
    assert len(masks) == 31 and {m.bit_count() for m in masks} <= {32, 33, 34}
    for _ in range(20_000):
        apart = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(not apart & m for m in masks)


def test_forest_joins_what_all_pairs_join():
    rng = np.random.default_rng(1)
    base = rng.integers(-2**63, 2**63 - 1, 30)
    bit = np.int64(1) << np.arange(64)
    members = np.unique(np.concatenate([base ^ bit[rng.integers(0, 64, 30)] ^ bit[rng.integers(0, 64, 30)] for _ in range(6)]))

    def classes(pairs):
        of = {int(m): int(m) for m in members}
        for a, b in pairs:
            x, y = of[a], of[b]
            of = {m: min(x, y) if c in (x, y) else c for m, c in of.items()}
        return of

    every = [(int(a), int(b)) for a in members for b in members if a < b and (int(a ^ b) % 2**64).bit_count() <= 4]
    links = simhash.forest(members, 4)
    assert classes(links) == classes(every) and len(links) < len(members)


def test_simhash_empty_table(spark):
    got = simhash.simhash_components(table(spark, []))
    assert got.columns == ["doc_id", "fingerprint", "component_id"] and got.count() == 0


# ---------------------------------------------------------------- personal data: places of very many matches
def test_places_of_forty_thousand_numbers(spark):
    """Once quadratic (91 s); a text full of numbers now takes seconds."""
    import time

    from pyspark.sql import functions as F

    from tastebud.llm import pii
    text = " ".join(f"é +49 30 {1_000_000 + i}" for i in range(40_000))
    began = time.time()
    found = spark.createDataFrame([(text,)], "t string").select(pii.matches(F.col("t"), pii.PATTERNS["phone"]).alias("m")).first()["m"]
    assert time.time() - began < 40
    assert len(found) == 40_000 and all(text[x["a"]:x["z"]] == x["m"] for x in found)
    assert [x["a"] for x in found] == [m.start() for m in re.finditer(r"\+", text)]


def test_generators_take_runs_of_any_length(spark):
    from pyspark.sql import functions as F

    from tastebud.llm import pii
    rows = [("7" * 45,), ("n" * 90 + "@" + "h" * 80 + ".a" * 12,), ("x" * 300_000,), ("",), (None,)]
    got = [r.asDict() for r in spark.createDataFrame(rows, "t string").select(
        *[pii.matches(F.col("t"), p).alias(g) for g, p in pii.GENERATORS.items()]).collect()]
    assert [[x["m"] for x in got[0]["number"]], [x["m"] for x in got[1]["address"]]] == [["7" * 45], [rows[1][0]]]
    assert got[2] == got[3] == {"address": [], "number": []}
