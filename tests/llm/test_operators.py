"""Each operator against a brute-force version on a small table, and on tables with every odd case."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tastebud.llm import chat, decontam, jaccard, lm, mixing, pii, quality, rules, secrets, urls
from tastebud.llm.common import connected_components, held_out

SYLLABLES = "an the on ing tion re ea st ed lo wei vi ou er le".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, word string, row long, score double"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, repeated rows, ties; extra columns clash with results."""
    rng = random.Random(3)
    long = " ".join(words(rng, 6000))
    plain = " ".join(words(rng, 60))
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, long, "en", "b"), (5, "x" * 20000, "en", "b"),
            (6, plain, "en", None), (7, plain, "en", "a"), (7, plain, "en", "a"), (None, plain, "en", "a"), (None, None, None, "ü"),
            (8, "one two", "en", "a"), (9, "ONE  two", "en", "a"), (10, plain + " mehr Wörter Ende", "de", "Z"),
            (11, "1 " * 3000 + "+" * 500 + "a@" * 300, "en", "Z"), (12, "\\ <s> [INST] \\<s>", "en", "b")]
    return [(i, t, lang, s, None, 5, "w", 0, 0.5) for i, t, lang, s in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def split(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------- mixing
def test_targets_are_capped_and_reshared():
    sizes = {"a": 10, "b": 1000, "c": 500, None: 0}
    got = mixing.targets(sizes, mixing.cyclic_weights(list(sizes)), 1510)
    assert got["a"] == 30 and got[None] == 0
    assert math.isclose(sum(got.values()), 1510) and math.isclose(got["b"] / 2, got["c"] / 3)


def test_mix_is_near_its_targets_nested_and_stable(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randint(1, 60))), "en", rng.choice(["hot"] * 5 + ["a", "b", None]), None, 1, "", 0, 0.0) for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mixed(docs, shares=(1.0, 0.25)).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mixed(docs.repartition(5), shares=(1.0, 0.25)).collect()}
    taken, target = collections.Counter(), {}
    for r in got:
        assert r["size"] == len(split(r["text"])) and r["taken"] <= 3 * r["size"] and again[r["doc_id"]] == r["taken"]
        assert r["taken_1"] <= r["taken"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_mix_odd_and_empty(odd, empty):
    got = mixing.mixed(odd).collect()
    assert len(got) == len(odd_rows()) and sum(r["doc_id"] is None for r in got) == 2
    assert all(r["taken"] == 0 for r in got if not split(r["text"]))
    assert mixing.mixed(empty).count() == 0


# ---------------------------------------------------------------- lattice likelihood
PIECES = {" th": -2.0, "e": -2.0, "th": -3.0, " ": -4.0, "an": -3.0, " an": -2.5, "d": -3.0, **{bytes([b]).decode("latin1"): -9.0 for b in b""}}


def pieces() -> dict[bytes, float]:
    out = {p.encode(): s for p, s in PIECES.items()}
    for b in range(256):
        out.setdefault(bytes([b]), -9.0)
    return out


def all_segmentations(word: bytes, logp: dict[bytes, float]) -> float:
    if not word:
        return 1.0
    return sum(math.exp(logp[word[:k]]) * all_segmentations(word[k:], logp) for k in range(1, len(word) + 1) if word[:k] in logp)


def test_lattice_sums_all_segmentations_and_counts_them():
    import numpy as np

    own = pieces()
    names = sorted(own)
    logp = np.array([own[p] for p in names] + [-1.0])
    lattice = lm.Lattice(names, logp)
    for w in [b"the", b"thande", b"and", "ä".encode(), b"x" * 60]:
        got = lattice.logs([w])[0, 0]
        if len(w) < 20:
            assert math.isclose(got, math.log(all_segmentations(b" " + w, own)) - 1.0, rel_tol=1e-9)
        assert math.isclose(lattice._long(b" " + w) - 1.0, got, rel_tol=1e-9)
    base, counts = lattice.logs([b"thande"])[0, 0], lattice.expect([b"thande"], np.ones((1, 1)))[0]
    up = logp.copy()
    k = names.index(b"an")
    up[k] += 1e-6       # expected counts are the gradient of the log probability
    assert math.isclose((lattice.logs([b"thande"], [logp, up])[0, 1] - base) / 1e-6, counts[k], rel_tol=1e-3)
    two = lattice.expect([b"thande", b"the", b"x" * 60], np.array([[1, 0], [0, 1], [1, 1]]))    # a row a class
    for z, own in enumerate(([b"thande", b"x" * 60], [b"the", b"x" * 60])):
        assert np.allclose(two[z], sum(lattice.expect([w], np.ones((1, 1)))[0] for w in own))


def test_scores_against_brute_force(spark, odd, empty):
    got = lm.lattice_scores(odd, held_out(odd["doc_id"], 7, 2), pieces(), rounds=1).collect()
    rows = odd_rows()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = collections.Counter()
    for i, text, *_ in rows:
        if not held(i):
            count.update([*split(text), None])
    n, v = sum(count.values()), len(count)
    want = sorted((i or -1, held(i), len(split(t)) + 1, sum(count[w] > 0 for w in [*split(t), None]), n,
                   round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*split(t), None]), 4)) for i, t, *_ in rows)
    assert sorted((r["doc_id"] or -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got) == want
    assert all(r["score"] < 0 for r in got)
    assert lm.lattice_scores(empty, held_out(empty["doc_id"], 7, 2), pieces()).count() == 0


def test_long_words_are_scored_alike_by_name_and_by_hash(spark, monkeypatch):
    rows = [(i, f"a {'-' * 80} b {'=' * (70 + i % 2)} {'+' * 100}", "x", "", 0, 0, "", 0, 0.0) for i in range(12)]
    docs, got = spark.createDataFrame(rows, DOCS), []
    for size in (64, 1000, 0):          # long words as hashes, all as names, all as hashes
        monkeypatch.setattr(lm, "FREQUENT_BYTES", size)
        got.append(sorted(map(str, lm.lattice_scores(docs, held_out(docs["doc_id"], 7, 2), pieces(), rounds=1).collect())))
    assert got[0] == got[1] == got[2]


@pytest.mark.parametrize("langs", ["----", "xyxy"])
def test_probabilities_of_words_sum_below_one(spark, langs):
    docs = spark.createDataFrame([(i, t, langs[i], "", 0, 0, "", 0, 0.0) for i, t in enumerate(["a b", "a", "ab ba", "b"])], DOCS)
    tests = spark.createDataFrame([(-1 - i, w, "", "", 0, 0, "", 0, 0.0) for i, w in enumerate(["a", "b", "ab", "ba", "aa", "bb", "c", "abc"])], DOCS)
    both = docs.unionByName(tests)
    got = lm.lattice_scores(both, both["doc_id"] < 0, pieces(), rounds=1).filter("doc_id < 0").collect()
    end = math.log10(5 / (10 + 2)) if langs == "----" else math.log10(3 / (4 + 2))     # of the class that ends most readily
    assert sum(10 ** (r["score"] - end) for r in got) < 1


def test_word_probabilities_of_a_class_sum_to_one():
    import numpy as np

    counts = np.array([[5, 0], [1, 3], [2, 0], [0, 2]])
    stats = lm.Words(13, 0.5, 0.5 * 4 + 1, 0.2, np.array([8 + 2, 5 + 1]), np.array([0.4, 0.6]), np.array([0.4 * 3 + 1, 0.6 * 2 + 1]))
    spelled = np.log(np.array([[0.1, 0.2], [0.3, 0.1], [0.2, 0.2], [0.1, 0.1], [0.3, 0.4]]))      # every word there is
    got = (10 ** stats.logs(np.vstack([counts, [0, 0]]), spelled)).sum(axis=0)
    assert np.allclose(got + np.array([3 / 12, 2 / 8]), 1)      # an end: its rows and one


def test_classes_beyond_the_last_share_one_and_beat_one_lattice(spark, monkeypatch):
    rng = random.Random(5)
    own = {lang: words(rng, 40) for lang in "abc"}
    rows = [(i, " ".join(rng.choices(own["abc"[i % 3]], k=30)), "abc"[i % 3], "", 0, 0, "", 0, 0.0) for i in range(120)]
    docs = spark.createDataFrame(rows, DOCS)

    def mean():
        got = lm.lattice_scores(docs, held_out(docs["doc_id"], 7, 2), pieces()).filter("held_out").collect()
        return sum(r["score"] for r in got) / sum(r["n_tokens"] for r in got)

    three = mean()
    monkeypatch.setattr(lm, "CLASSES", 2)
    two = mean()
    monkeypatch.setattr(lm, "CLASSES", 1)
    assert three > two > mean()


# ---------------------------------------------------------------- Jaccard join
def components(rows: list[tuple], width: int, percent: int) -> list[tuple]:
    sets = []
    for i, text, *_ in rows:
        w = split(text)
        sets.append((i, frozenset(tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()))
    group = list(range(len(sets)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, (_, x) in enumerate(sets):
        for b in range(a):
            y = sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                group[root(a)] = root(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        if i is not None:
            low[root(a)] = min(low.get(root(a), i), i)
    return sorted(((i, len(x), low.get(root(a))) for a, (i, x) in enumerate(sets)), key=str)


def edited(rng: random.Random, base: list[str], edits: int) -> str:
    out = list(base)
    for _ in range(edits):
        out[rng.randrange(len(out))] = "edit" + str(rng.randrange(10**6))
    return " ".join(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    rows, passage = [], " ".join(words(rng, 60))
    for size in (3, 5, 6, 9, 10, 11, 14, 16, 20, 25, 60, 150, 400):
        base = words(rng, size)
        for _ in range(12):
            rows.append(edited(rng, base, rng.choice([0, 0, 1, 1, 2, size // 40, size // 25])))
    rows += [" ".join(words(rng, 8)) + " " + passage + " " + " ".join(words(rng, rng.randint(1, 30))) for _ in range(30)]
    rng.shuffle(rows)
    rows = [(i, t) for i, t in enumerate(rows)] + [(5, rows[5]), (None, rows[6])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(docs).collect()), key=str)
    assert got == components(rows, 4, 85)


def test_components_odd_and_empty(odd, empty):
    got = sorted((tuple(r) for r in jaccard.jaccard_components(odd).collect()), key=str)
    assert got == components(odd_rows(), 4, 85)
    assert jaccard.jaccard_components(empty).count() == 0
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 2, 3, 4, 5, 6, 8, 11, 12]


def test_boundary_weighs_subsets_against_lists():
    assert jaccard.boundary([(6, 100, 1e6), (13, 100, 1e6), (25, 100, 1e4)], 85) == 15
    assert jaccard.boundary([(25, 1, 2.0)], 85) < 25
    assert jaccard.subsets_of(14, 85) == 1 + 14 + 91


def test_small_sets_with_long_lists_link_by_subsets(spark, monkeypatch):
    rng = random.Random(21)
    start = " ".join(f"w{k}" for k in range(11))                # 8 shingles; with one more word 9, of which 8 are common
    texts = [start if k % 50 == 7 else f"{start} x{rng.randrange(200)}" if k % 3 else " ".join(words(rng, 12)) for k in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    chosen, boundary = [], jaccard.boundary
    monkeypatch.setattr(jaccard, "boundary", lambda *a: chosen.append(boundary(*a)) or chosen[-1])
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(df).collect()}
    assert 9 < 0.85 * (chosen[0] + 1)       # no set has list keys: every link is one of subsets
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in (t.split() for t in texts)]
    want = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 85 * len(a | sets[j]) and want[i] != want[j]:
                low, high = sorted((want[i], want[j]))
                want = [low if x == high else x for x in want]
    assert got == dict(enumerate(want))
    assert len({t for t, c in zip(texts, want, strict=True) if c == want[7]}) > 100


def test_counts_are_held_one_range_at_a_time():
    import numpy as np
    import pyarrow as pa

    def rows(k, once, more):
        return (k, np.array(once, "<u4").tobytes(), np.array([h for h, _ in more], "<u4").tobytes(), np.array([c for _, c in more], "<u4").tobytes())

    first = 3 << (32 - jaccard.RANGES)
    got = [rows(0, [5, 9 << 8], []), rows(0, [5], [(1 << 15, 6)]), rows(3, [first + 7], [(first + (1 << 10), 2)])]
    batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in part]) for i in range(4)], ["range", "once", "more", "times"])
               for part in (got[:1], got[1:])]
    out = [r for b in jaccard._tables(iter(batches)) for r in b.to_pylist()]
    assert [r["range"] for r in out] == [0, 3]
    flags = [np.flatnonzero(np.unpackbits(np.frombuffer(r["flags"], np.uint8))).tolist() for r in out]
    assert flags == [[0, (1 << 15) >> 5], [(1 << 10) >> 5]]           # 9 << 8 and first + 7 occur once
    level = np.frombuffer(out[0]["levels"], np.uint8)
    assert level[0] == 1 and level[(1 << 15) >> 8] == 2


def test_counts_are_shuffled_in_two_bytes_a_hash():
    import numpy as np

    dense = np.unique(np.random.default_rng(3).integers(0, 1 << 22, 1000, dtype=np.uint32)) + np.uint32(7 << 22)
    assert len(jaccard._packed(dense)) <= 2 * len(dense) + 8
    for h in (dense, dense[:1], dense[:0], np.array([0, 65535, 131071, 2**32 - 1], np.uint32), np.array([5, 65540], np.uint32)):
        assert jaccard._unpacked(jaccard._packed(h)).tolist() == h.tolist()


def test_sketches_are_as_long_as_sets_ask_for(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    limits = jaccard.sketch_limits(80)
    assert [w for w, _ in limits] == [2, 4, 8] and jaccard.sketch_limits(100)[0][1] > 1000
    sets, rows = [], []
    for n in (1, 90, limits[0][1], limits[0][1] + 9, limits[1][1], limits[1][1] + 30, limits[2][1] + 50):
        s = rng.integers(0, 2**64, n, dtype=np.uint64)
        sets += [s, np.append(s[n // 20 :], rng.integers(0, 2**64, 1 + n // 12, dtype=np.uint64)), rng.integers(0, 2**64, n, dtype=np.uint64)]
    sketches = [jaccard.sketch_of(s, 80) for s in sets]
    for s, sketch in zip(sets, sketches, strict=True):
        words = next((w for w, most in limits if len(s) <= most), jaccard.SKETCH_WORDS)
        assert len(sketch) == jaccard.SKETCH_WORDS and not sketch[words:].any()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            rows.append((i, j, len(a), len(b), len(np.setxor1d(a, b)), *sketches[i].tolist(), *sketches[j].tolist()))
    both = [f"{side}_s{k} long" for side in "lr" for k in range(jaccard.SKETCH_WORDS)]
    got = spark.createDataFrame(rows, "i int, j int, l_n long, r_n long, really long, " + ", ".join(both)).selectExpr("*", f"{jaccard.apart(80)} AS apart").collect()
    assert all(r["apart"] <= r["really"] and r["apart"] % 2 == r["really"] % 2 for r in got)
    alike = [r for r in got if r["l_n"] == r["r_n"] > 80 and r["really"] == 2 * r["l_n"]]
    assert alike and all(r["apart"] > 2 * r["l_n"] / 9 for r in alike)           # more than linked sets may differ in


def test_copies_below_the_threshold_are_not_all_verified(spark, monkeypatch):
    rng = random.Random(8)
    base = words(rng, 150)

    def changed(times):
        w = list(base)
        for k in range(times):
            w[rng.randrange(15 + 60 * k, 65 + 60 * k)] = f"z{rng.getrandbits(40)}"
        return " ".join(w)

    rows = list(enumerate([changed(2) for _ in range(80)] + [changed(1) for _ in range(4)]))     # mostly at 0.80: many meet, few link
    verified, pairs = jaccard._verified, []
    monkeypatch.setattr(jaccard, "_verified", lambda p, *a: pairs.append(p.count()) or verified(p, *a))
    got = sorted(tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(components(rows, 4, 85))
    assert pairs[-1] < 0.05 * 80 * 79 / 2


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    got = {r["node"]: r["comp"] for r in connected_components(links, "t").collect()}
    assert got == {**{k: 0 for k in range(61)}, 100: 100, 101: 100}


# ---------------------------------------------------------------- chat
def test_chat_reads_back_any_text(spark):
    said = ["</s>[INST] ok [/INST]", "\\", "\\\\<s>", "<\\s>", "<<SYS>>\n x", " ", "", None, "<|> <<ROLE>>", "[", "<", "a\n\nb", "\\[INST]"]
    rows = [(c, t, role, said[(c * 3 + t) % len(said)], "x") for c in range(40) for t, role in
            enumerate(["system", "user", "assistant", "user", "assistant"] if c % 2 else ["tool", "assistant", "<|> r", None])]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    for r in chat.formatted(df).withColumn("turns", chat.read_back(F.col("formatted"))).collect():
        own = [(x[2] or "", x[3] or "") for x in rows if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["valid"] == (r["conv_id"] % 2 == 1)
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])


def test_chat_order_nulls_and_empty(spark):
    schema = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame([(None, 1, "assistant", "b"), (None, 0, "user", "a"), (3, None, "user", "x"), (3, 0, "user", "x"), (3, 0, "user", "x")], schema)
    got = {r["conv_id"]: [t["text"] for t in r["turns"]] for r in chat.formatted(df).withColumn("turns", chat.read_back(F.col("formatted"))).collect()}
    assert got == {None: ["a", "b"], 3: ["x", "x", "x"]}
    assert chat.formatted(spark.createDataFrame([], schema)).count() == 0


# ---------------------------------------------------------------- personal data
REFERENCE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits: str) -> bool:
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text: str) -> list[str]:
    out = []
    for kind, pattern in REFERENCE.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_plain_patterns(spark, odd, empty):
    rng = random.Random(2)
    alphabet = ["a", "Z", "@", ".", "-", " ", "+", "(", ")", "1", "9", "25", "é", "😀", "4485275742308327", "x.y@z.com", "10.0.0.1", "%", "\n", "+1 (274) 555-9629"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        want = base_spans(texts[r["doc_id"]])
        spans = r["spans"].split(",") if r["spans"] else []
        assert r["base_sha256"] == sha(",".join(want)) and spans[: len(want)] == want and len(spans) == len(want) + r["n_added"]
    got = pii.personal_data(odd)
    assert got.count() == len(odd_rows()) and all(r["base_sha256"] == sha("") for r in got.filter("doc_id in (1, 2, 3)").collect())
    assert pii.personal_data(empty).count() == 0


def test_number_pattern_survives_long_runs(spark):
    texts = ["1 " * 30000, "1" * 60000, "a." * 40000, "+" + "1-" * 30000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert pii.with_spans(df).select(F.sum(F.size("card"))).first()[0] == 0


# ---------------------------------------------------------------- rules
def test_ledger_equals_brute_force(spark, odd, empty):
    rng = random.Random(4)
    texts = [r[1] for r in odd_rows()]
    for _ in range(60):
        line = " ".join(words(rng, rng.randint(1, 12)))
        texts.append("\n".join(rng.choice([line, " ".join(words(rng, 5)), "", "## $$", " "]) for _ in range(rng.randint(1, 12))))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in rules.ledger(df).collect():
        t = texts[r["doc_id"]] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        seen = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        marked = {k + j for k in range(len(w) - 4) if seen[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked))
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert (r["fail_bits"] & rules.mask("base") != 0) == (len(w) < 10 or 100 * len(marked) > 20 * len(w))
    assert rules.ledger(odd).count() == len(odd_rows()) and rules.ledger(empty).count() == 0


def test_ablation_counts_by_bits(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (2,), (64,)], "fail_bits long")
    got = {r["rule"]: (r["rejected"], r["rejected_alone"]) for r in rules.ablation(rows, "base").collect()}
    assert got == {"too_short": (3, 2), "repeated_windows": (2, 1)}


# ---------------------------------------------------------------- URLs
def test_urls_equal_brute_force(spark, monkeypatch):
    listed = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("com", "/de/", "block"), ("a.b.com", "/de/x", "allow"), ("com", "/de/", "allow")]
    hosts, paths = ["org", "x.org", "EXAMPLE.org", "m.example.org", "com", "a.b.com", "c.a.b.com", "xa.b.com", ""], ["", "/", "/es/", "/es", "/de/x?y#/z", "#/es/", "/de/", "/de/xy"]
    pages = [(k, s + h + p) for k, (s, h, p) in enumerate((s, h, p) for s in ("http://", "x://y://", "") for h in hosts for p in paths)] + [(None, None), (0, "http://org/"), (999, "")]
    table = spark.createDataFrame(listed, "host string, path string, verdict string")
    df = spark.createDataFrame([(*p, "h") for p in pages], "page_id long, url string, host string")

    def want(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fit = [(len(a + b), a + b, v) for a, b, v in listed if (host == a or host.endswith("." + a)) and path.startswith(b)]
        best = max(fit, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    got = urls.judged(df, table).collect()
    assert sorted(map(str, got)) == sorted(str(type(got[0])(p, *want(u))) for p, u in pages) or sorted(
        (str(r["page_id"]), r["host"], r["path"], str(r["rule"]), r["verdict"]) for r in got) == sorted(
        (str(p), *want(u)[:2], str(want(u)[2]), want(u)[3]) for p, u in pages)
    monkeypatch.setattr(urls, "LARGEST_BLOCKS", 0)      # the filter as a table of blocks
    assert sorted(map(str, urls.judged(df, table).collect())) == sorted(map(str, got))
    none = urls.judged(df, table.limit(0)).collect()
    assert len(none) == len(pages) and {r["verdict"] for r in none} == {"allow"}
    assert urls.judged(df.limit(0), table).count() == 0


def test_bloom_has_every_key_and_few_others(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    table = urls.bloom(keys, 600).first()["words"]
    probe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"), "id").withColumn("words", F.lit(table))
    hit = F.get("words", urls.block_of(F.col("key"), 600)).bitwiseAND(urls.pattern_of(F.col("key"))) == urls.pattern_of(F.col("key"))
    got = probe.filter(hit).agg(F.count_if(F.col("id") < 2000), F.count_if(F.col("id") >= 2000)).first()
    assert got[0] == 2000 and got[1] < 900


# ---------------------------------------------------------------- secrets
def secret_texts(rng: random.Random) -> list[str]:
    out = []
    for k in range(300):
        w = words(rng, 40)
        if k % 3 == 0:
            w[20] = "password=" + "".join(rng.choices("0123456789abcdef", k=18))
        if k % 3 == 1:
            w[10] = 'token = "' + "".join(rng.choices("0123456789abcdef", k=40)) + '"'
        out.append(" ".join(w))
    return out


def test_secrets_base_and_field(spark, odd, empty):
    rng = random.Random(6)
    texts = secret_texts(rng)
    field = secrets.train(texts)
    memo, slack = secrets.WordScores(field), field.slack()
    plain = " ".join(words(rng, 2000))
    assert secrets.secret_spans(plain, memo, field, slack) == ([], [])
    hidden = 'the value "7F40EBFF6C61EDCDA65DD45413DD21D8D661DC61" is on'       # upper case: no rule has it
    assert secrets.secret_spans(hidden, memo, field, slack) == ([], [("crf", 11, 51)])
    got = secrets.scan(odd, field).collect()
    assert len(got) == len(odd_rows()) and all(r["base_sha256"] == sha("") and r["spans"] == "" for r in got if not (r["doc_id"] or 99) > 3)
    assert secrets.scan(empty, field).count() == 0 and secrets.fitted(empty) is not None
    clean = secrets.redacted(spark.createDataFrame([(1, texts[0]), (2, None), (3, plain)], "doc_id long, text string"), field).collect()
    assert "[SECRET]" in clean[0]["text"] and "password=" not in clean[0]["text"] and clean[1]["text"] is None and clean[2]["text"] == plain


def test_training_sees_every_tagged_word(monkeypatch):
    rng = random.Random(13)
    text = " ".join([f"n{k}" for k in range(300)] + [f"AKIA{rng.randrange(10**14):014d} and so on then" for _ in range(60)])
    seen: list[str] = []
    rows = secrets.Field.rows
    monkeypatch.setattr(secrets.Field, "rows", lambda self, w, doc: seen.append(w) or rows(self, w, doc))
    secrets.train([text], epochs=1)
    keys = {w for w in text.split() if w.startswith("AKIA")}
    assert len(keys) == 60 and keys <= {w for window in seen for w in window}
    assert len(seen) == 60 + secrets.OTHERS + 2
    assert any("n290" < w for window in seen[:40] for w in window if w[0] == "n" and len(w) == 4)     # not a prefix of the text


def test_features_read_a_word_to_its_end(spark):
    rng = random.Random(17)
    start = "x" * 300
    plain, other = secrets.word_features(start + "abcd"), secrets.word_features(start + "auth=A7b9")
    assert "k:auth" in other and "k:auth" not in plain and len(set(plain) ^ set(other)) > 3
    assert secrets.shape("a9" * 500) == "a9+" and secrets.shape("a9" * 500 + "-B") == "a9+-A"
    field = secrets.train(secret_texts(rng))
    memo, slack = secrets.WordScores(field), field.slack()
    line = "{" + ",".join(f'{a}:{b}' for a, b in zip(words(rng, 60), words(rng, 60), strict=True))      # one line without spaces
    secret = "".join(rng.choices("0123456789ABCDEF", k=40))
    text = f'{line},"{secret}",{line[1:]}' + "}"
    at = len(line) + 2
    assert secrets.secret_spans(text, memo, field, slack) == ([], [("crf", at, at + 40)])


def test_windows_are_bounded_by_hash(spark, monkeypatch):
    rng = random.Random(19)
    seen: list[int] = []
    rows = secrets.Field.rows
    monkeypatch.setattr(secrets.Field, "rows", lambda self, w, doc: seen.append(len(w)) or rows(self, w, doc))
    secrets.train(secret_texts(rng), epochs=1, windows=100)
    assert len(seen) == 100
    texts = [(k, t) for k, t in enumerate(secret_texts(rng))] + [(1000, " \n "), (1001, ",,,"), (1002, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    field = secrets.fitted(docs.unionByName(docs.limit(100)), sample=50)
    assert abs(field.w).max() > 0 and (field.w == secrets.fitted(docs.repartition(3), sample=50).w).mean() > 0.5


def test_pruned_decoding_is_the_best_sequence():
    import numpy as np

    rng = random.Random(8)
    texts = secret_texts(rng)[:60]
    field = secrets.train(texts)
    memo, slack = secrets.WordScores(field), field.slack()
    for text in texts[:30]:
        w = split_cased(text)
        table = memo.of(w)
        e = table[:, :3].copy()
        e[1:] += table[:-1, 3:6]
        e[:-1] += table[1:, 6:9]
        e[0] += field.w[secrets.slots(["first"], "<")].sum(axis=0)
        e[-1] += field.w[secrets.slots(["last"], ">")].sum(axis=0)
        e += field.w[secrets.slots(secrets.text_features(text), "doc")].sum(axis=0)
        tags = np.array(field.viterbi(e, None, None))
        starts = [i for i, t in enumerate(tags) if t == secrets.B or t == secrets.I and (i == 0 or tags[i - 1] == secrets.O)]
        assert [a for a, _ in secrets.decode(text, w, table, field, slack)] == starts


def split_cased(text: str) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text)


# ---------------------------------------------------------------- decontamination
def brute_alignment(item: list, passage: list) -> int:
    best, prev = 0, [0] * (len(passage) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(passage, 1):
            row.append(max(0, prev[j - 1] + (2 if a == b else -1), prev[j] - 1, row[-1] - 1))
            best = max(best, row[-1])
        prev = row
    return best


def test_alignment_equals_the_plain_recursion():
    import numpy as np

    rng = random.Random(9)
    for _ in range(200):
        a, b = rng.choices(range(1, 6), k=rng.randint(1, 15)), rng.choices(range(1, 6), k=rng.randint(1, 30))
        score, first, last = decontam.smith_waterman(np.array(a), np.array(b))
        assert score == brute_alignment(a, b)
        if score:
            assert brute_alignment(a, b[first:last]) == score


def test_copies_are_found_and_clean_texts_left(spark, odd, empty):
    rng = random.Random(10)
    items = [(k, " ".join(words(rng, 40))) for k in range(8)]
    docs, want = [], set()
    for d in range(80):
        w = words(rng, 200)
        if d % 4 == 0:
            copy = items[d % 8][1].split()
            if d % 8:
                for _ in range(4):
                    copy[rng.randrange(40)] = "other"
                del copy[20]
            w[50:50] = [x.upper() + "," for x in copy] if d % 3 == 0 else copy
            want.add((d, d % 8))
        docs.append((d, " ".join(w)))
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([*items, (90, None), (None, "")], "item_id long, text string")
    got = decontam.contaminated(df, bench).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    kept = decontam.decontaminated(odd.unionByName(df, allowMissingColumns=True), bench)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows()) + 60
    assert decontam.contaminated(empty, bench).count() == 0 and decontam.contaminated(df, bench.limit(0)).count() == 0


def test_edited_copies_are_those_of_all_pairs(spark):
    """10 to 40 % of the words edited, and one exact copy beside the only edited one."""
    rng = random.Random(12)
    items = [(k, words(rng, 40)) for k in range(6)]
    docs = []
    for d in range(60):
        copy = list(items[d % 6][1])
        for i in rng.sample(range(40), 4 + d % 13):
            copy[i] = [f"new{d}"] if d % 4 == 0 else [] if d % 4 == 1 else [copy[i], "more"] if d % 4 == 2 else [rng.choice(items[0][1])]
        docs.append((d, words(rng, 30) + [w for x in copy for w in ([x] if isinstance(x, str) else x)] + words(rng, 30)))
    items += [(6, words(rng, 40)), (7, ["été", "straße", "école"] * 4)]
    spread = list(items[6][1])
    spread[3::7] = ["other"] * len(spread[3::7])      # breaks more than half of the 4-grams
    docs += [(100, words(rng, 20) + items[6][1]), (101, words(rng, 20) + spread), (102, [w.upper() for w in ["été", "école"]] * 6)]
    docs += [(103, [x for w in items[6][1] for x in (w, "between")])]    # no two words of the item stand together
    want = {}
    for d, doc in docs:
        for k, item in items:
            score = brute_alignment(item, [w.lower() for w in doc]) / (2 * len(item))
            if score >= 0.5:
                want[d, k] = score
    assert {(100, 6), (101, 6), (102, 7), (103, 6)} <= set(want) and len(want) > 30
    df = spark.createDataFrame([(d, " ".join(doc)) for d, doc in docs], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(item)) for k, item in items], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in decontam.contaminated(df, bench).collect()} == want
    kept = {r["doc_id"] for r in decontam.decontaminated(df, bench).collect()}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


# ---------------------------------------------------------------- quality
def test_quality_learns_and_scores_odd_rows(spark, odd, empty):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        w = words(rng, 60)
        rows.append((i, " ".join(w) if i % 2 else " ".join(x.upper() + "!!" for x in w), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels, held_out(docs["doc_id"], 3, 1)).filter("held_out").collect()
    assert len(got) > 100 and all(r["predicted"] == r["doc_id"] % 2 for r in got)
    seen = quality.quality_scores(odd, labels, held_out(odd["doc_id"], 3, 1)).collect()
    assert len(seen) == len(odd_rows()) and all(0 <= r["score"] <= 1 for r in seen)
    assert quality.quality_scores(empty, labels, held_out(empty["doc_id"], 3, 1)).count() == 0
    none = quality.quality_scores(docs, labels.limit(0), held_out(docs["doc_id"], 3, 1)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.accepted(odd, labels, held_out(odd["doc_id"], 3, 1)).columns == odd.columns


def test_a_score_sums_its_rows():
    import numpy as np

    number = np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32)
    memo = quality.WordNumbers(number)
    texts = [b"the the cat", b"", b"a " * 5000, None, "é ü".encode()]
    got = quality.text_scores(texts, memo, 0.25)
    for t, s in zip(texts, got, strict=True):
        f = quality.features(t)
        z = 0.25 + (number[f].sum(dtype=np.float64) / len(f) if len(f) else 0)
        assert math.isclose(s, 1 / (1 + math.exp(-z)), rel_tol=1e-5)
