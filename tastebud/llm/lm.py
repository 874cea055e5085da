"""Subword lattice likelihood: the probability of a text over all its segmentations.

A vocabulary of pieces with existing scores spans a lattice over every word: a
space, the word's UTF-8 bytes, a stop (single bytes are always pieces).  The
forward recursion in log space sums the weight of all segmentations, so a
word's probability is marginal, not that of its best split.  First pieces,
those with the space, are one distribution, the others and the stop another.
A word of the training rows is one more arc, over its whole lattice: of its c
occurrences c - d weigh that arc, and the discounts d of all words weigh the
pieces.  A text is its words and one end; all probabilities sum to 1.

Lattices come in classes, learned from the training rows of one language each:
the CLASSES - 1 most frequent values of ``lang``, the others (null is a value)
sharing the last.  A class has its own word counts and piece scores; what its
discounts leave goes to its pieces and, by the part SHARED, to the words of all
classes.  The class of a text is not given to its score: the probability is
summed over classes too, each weighed by its share of the training rows.

The piece scores are re-estimated on the training rows: expected counts from
forward and backward passes over the *distinct* words of the corpus (the
discounts are one a word and class), with the existing scores as a prior of the
common scores, and these as a prior of each class's.  Word counts are a grouped
sum over all documents; the pieces are a vocabulary of fixed size.

Each distinct word goes through the lattice once.  Words that make up more than
1/2**FREQUENT_BITS of the corpus (so at most 2**FREQUENT_BITS; those over
FREQUENT_BYTES bytes as their hashes) are broadcast; all other words of a document meet their
count and score in a join on the word's hash.

Null or empty text: only the end token.  A null ``doc_id`` is not held out.
Repeated rows are scored apiece.  With no training rows the existing scores
and N = V = 0 hold.  An empty table gives no rows.  Besides text, ``lang`` is
needed, null or not.  A word of any length is spelled whole.  Extra columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, ship_package, words_of

FREQUENT_BITS, FREQUENT_BYTES = 17, 64
LONGEST = 48            # bytes of words that go through the lattice in blocks; longer ones go one by one
BLOCK = 4_000           # words in a block
CHUNK = 120_000         # words sorted into blocks together
TASK_WORDS = 300_000    # distinct words counted together by one map task
CLASSES = 8             # lattices that a text's probability is summed over
SHARED = 0.05           # part of a class's discounts that goes to the words of all classes
CLASS_PRIOR = 500.0     # weight, in pieces, of the common scores in a class's
NONE = -1e30


def load_pieces(path: str, rank_scores: bool = True) -> dict[bytes, float]:
    """Lower-case pieces of a SentencePiece model with log weights, all single bytes among them.

    Of a merge-ranked vocabulary the score is minus the rank: the weight is then Zipf's, 1 / (rank + 1).
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces: dict[bytes, float] = {}
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i):
            continue
        piece = sp.id_to_piece(i).replace("▁", " ").encode()
        if piece != piece.lower() or b" " in piece[1:]:
            continue
        score = sp.get_score(i)
        pieces[piece] = -math.log(1 - score) if rank_scores else score
    low = min(pieces.values(), default=0.0)
    for b in range(256):
        pieces.setdefault(bytes([b]), low)
    return pieces


class Lattice:
    """Forward and backward passes over blocks of words."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[bytes], logp: np.ndarray) -> None:
        self.pieces, self.logp, self.stop = pieces, np.append(logp[:-1], NONE), logp[-1]    # last: the stop
        self.index = {p: i for i, p in enumerate(pieces)}
        self.most = max(map(len, pieces))
        hashes = np.array([self._hash(p) for p in pieces], np.uint64)
        self.levels, left, bits = [], np.arange(len(pieces)), 18
        while len(left):    # pieces whose slot is taken go to the next, smaller table
            slot = (hashes[left] >> np.uint64(64 - bits)).astype(np.int64)
            keys, ids = np.zeros(1 << bits, np.uint64), np.full(1 << bits, len(pieces), np.int64)
            _, first = np.unique(slot, return_index=True)
            keys[slot[first]], ids[slot[first]] = hashes[left[first]], left[first]
            self.levels.append((bits, keys, ids))
            left = np.delete(left, first)
            hashes_left = hashes[left] * self.FACTOR
            hashes = hashes.copy()
            hashes[left] = hashes_left
            bits = max(bits - 3, 10)

    def _hash(self, piece: bytes) -> int:
        h = 0
        for b in piece:
            h = (h * int(self.FACTOR) + b + 1) * 0xD6E8FEB86659FD93 & (2**64 - 1)
            h ^= h >> 32
        return h * 0xA0761D6478BD642F & (2**64 - 1)

    def _find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(h.shape, len(self.pieces), np.int64)
        for bits, keys, ids in self.levels:
            slot = (h >> np.uint64(64 - bits)).astype(np.int64)
            hit = keys[slot] == h
            out = np.where(hit, ids[slot], out)
            h = h * self.FACTOR
        return out

    def _arcs(self, block: np.ndarray) -> list[list[np.ndarray]]:
        """Piece ids by start and length, for words of one length."""
        n, size = block.shape
        arcs = []
        for i in range(size):
            h, row = np.zeros(n, np.uint64), []
            for k in range(i, min(size, i + self.most)):
                h = (h * self.FACTOR + block[:, k] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(32)
                row.append(self._find(h * np.uint64(0xA0761D6478BD642F)))
            arcs.append(row)
        return arcs

    def _forward(self, arcs, n: int) -> np.ndarray:
        size = len(arcs)
        alpha = np.full((size + 1, n), NONE)
        alpha[0] = 0
        for j in range(1, size + 1):
            alpha[j] = np.logaddexp.reduce([alpha[i] + self.logp[arcs[i][j - i - 1]] for i in range(max(0, j - self.most), j)])
        return alpha

    def _long(self, word: bytes, counts: np.ndarray | None = None, weight: np.ndarray | float = 0) -> float:
        """The same for one long word, through scaled sums so that its length costs time only."""
        spans = [[self.index.get(word[i : i + k]) for k in range(1, min(self.most, len(word) - i) + 1)] for i in range(len(word))]
        alpha = [NONE] * (len(word) + 1)
        alpha[0] = 0.0
        for j in range(1, len(word) + 1):
            terms = [alpha[i] + self.logp[p] for i in range(max(0, j - self.most), j) if (p := spans[i][j - i - 1]) is not None]
            top = max(terms)
            alpha[j] = top + math.log(sum(math.exp(t - top) for t in terms))
        if counts is not None:
            beta = [NONE] * (len(word) + 1)
            beta[-1] = 0.0
            for i in reversed(range(len(word))):
                terms = [(self.logp[p] + beta[i + k + 1], p, i + k + 1) for k, p in enumerate(spans[i]) if p is not None]
                top = max(t[0] for t in terms)
                beta[i] = top + math.log(sum(math.exp(t[0] - top) for t in terms))
                for t, p, _ in terms:
                    counts[:, p] += weight * math.exp(alpha[i] + t - alpha[-1])
        return alpha[-1]

    @staticmethod
    def _blocks(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
        """(places, bytes): blocks of words of one length, the space before them; long words alone, without bytes."""
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_size.setdefault(len(w) + 1, []).append(i)
        for size, own in by_size.items():
            if size > LONGEST:
                yield from ((np.array([i]), None) for i in own)
                continue
            for at in range(0, len(own), BLOCK):
                idx = np.array(own[at : at + BLOCK])
                yield idx, np.frombuffer(b"".join(b" " + words[i] for i in idx), np.uint8).reshape(len(idx), size).astype(np.uint64)

    def expect(self, words: list[bytes], weights: np.ndarray) -> np.ndarray:
        """Expected piece counts, a row a class; ``weights`` has a row a word, a column a class."""
        counts = np.zeros((weights.shape[1], len(self.pieces) + 1))
        for idx, block in self._blocks(words):
            if block is None:
                self._long(b" " + words[idx[0]], counts, weights[idx[0]])
                continue
            arcs, w = self._arcs(block), weights[idx]
            alpha, beta = self._forward(arcs, len(idx)), np.full((len(arcs) + 1, len(idx)), NONE)
            own = [np.flatnonzero(w[:, z]) for z in range(w.shape[1])]
            beta[-1] = 0
            for i in reversed(range(len(arcs))):
                terms = np.array([self.logp[p] + beta[i + k + 1] for k, p in enumerate(arcs[i])])
                beta[i] = np.logaddexp.reduce(terms)
                ids, part = np.array(arcs[i]), np.exp(alpha[i] + terms - alpha[-1])
                for z, at in enumerate(own):
                    if len(at):
                        counts[z] += np.bincount(ids[:, at].ravel(), (part[:, at] * w[at, z]).ravel(), counts.shape[1])
        return counts[:, :-1]

    def logs(self, words: list[bytes], tables: list[np.ndarray] | None = None) -> np.ndarray:
        """Natural log of each word's probability from pieces; with tables of scores a column for each."""
        kept = self.logp, self.stop
        tables = [np.append(self.logp[:-1], self.stop)] if tables is None else tables
        out = np.zeros((len(words), len(tables)))
        for idx, block in self._blocks(words):
            arcs = None if block is None else self._arcs(block)
            for z, logp in enumerate(tables):
                self.logp, self.stop = np.append(logp[:-1], NONE), logp[-1]
                out[idx, z] = self.stop + (self._long(b" " + words[idx[0]]) if arcs is None else self._forward(arcs, len(idx))[-1])
        self.logp, self.stop = kept
        return out


def normalized(count: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log probabilities: first pieces among themselves, the others with the stop."""
    return np.log(np.where(first, count / count[first].sum(), count / count[~first].sum()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns text, class (null: only scored) to word, class, count."""
    seen: dict[int, Counter] = defaultdict(Counter)

    def flush() -> Iterator[pa.RecordBatch]:
        for z, own in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.binary()), pa.array([z] * len(own), pa.int32()),
                                              pa.array(list(own.values()), pa.int64())], ["word", "z", "c"])
        seen.clear()

    for batch in batches:
        for text, z in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            if z is None:
                seen[0].update(dict.fromkeys(words, 0))
            else:
                seen[z].update(words)
            if sum(map(len, seen.values())) >= TASK_WORDS:
                yield from flush()
    yield from flush()


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches in groups of CHUNK rows: blocks of one word length stay large."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= CHUNK:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def by_class(batch: pa.Table, at: int, classes: int) -> np.ndarray:
    """Columns ``at`` and on, one a class, as a matrix with a row a word."""
    return np.stack([batch.column(at + z).to_numpy() for z in range(classes)], axis=1)


def _expect(model, classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*model.value)
        total = np.zeros((classes, len(lattice.pieces)))
        for batch in chunks(batches):
            total += lattice.expect(batch.column(0).to_pylist(), (by_class(batch, 1, classes) > 0) * 1.0)
        for z, own in enumerate(total):
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([z] * len(used), pa.int32()), pa.array(used, pa.int32()), pa.array(own[used])],
                                             ["z", "piece", "expected"])
    return run


@dataclass(frozen=True)
class Words:
    """What the training rows say of words: of all, and of each class."""
    total: int              # words
    discount: float
    spare: float            # what the discounts leave
    shared: float           # part of a class's spare that goes to the words of all
    totals: np.ndarray
    discounts: np.ndarray
    spares: np.ndarray

    def logs(self, counts: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """log10 of words' probabilities, a column a class, from counts by class and logs from pieces."""
        every = np.maximum(counts.sum(axis=1, keepdims=True) - self.discount, 0) / (self.total + 1)
        left = np.log(self.shared * self.spare / (self.total + 1) + 1 - self.shared) + spelled
        whole = np.maximum(counts - self.discounts, 0) + self.spares * self.shared * every
        logs = np.logaddexp(np.log(np.maximum(whole, 1e-300)), np.log(self.spares) + left)
        return (logs - np.log(self.totals + 2)) / math.log(10)


def _score(model, stats: Words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, common, tables = model.value
        lattice = Lattice(names, common)
        for batch in chunks(batches):
            words, counts = batch.column(0).to_pylist(), by_class(batch, 1, len(tables))
            logs = stats.logs(counts, lattice.logs(words, tables))
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.binary()), pa.array(counts.sum(axis=1)),
                 pa.array(np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64).view(np.int64)),
                 *(pa.array(logs[:, z]) for z in range(len(tables)))],
                ["word", "c", "h", *(f"lp{z}" for z in range(len(tables)))])
    return run


def _short(word: bytes) -> bytes:
    """The word, or of a long one its hash behind a space, which no word has."""
    return word if len(word) <= FREQUENT_BYTES else b" " + xxhash.xxh64_digest(word)


def _documents(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, base, lp, known = frequent.value
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                words = words_of(text)
                at = np.fromiter((index.get(_short(w), -1) for w in words), np.int64, len(words))
                own = at[at >= 0]
                rare = Counter([w for w, k in zip(words, at.tolist(), strict=True) if k < 0]) if len(own) < len(words) else {}
                rows.append((len(words) + 1, int(known[own].sum()), float(base[own].sum()), lp[own].sum(axis=0).tolist(),
                             np.array([xxhash.xxh64_intdigest(w) for w in rare], np.uint64).view(np.int64), list(rare.values())))
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))],
                                             ["doc_id", "held_out", "n_tokens", "known", "base", "lp", "rare", "times"])
    return run


def discount_of(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def lattice_scores(docs: DataFrame, held, pieces: dict[bytes, float], rounds: int = 2, prior: float = 100.0) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    ``held`` is a Boolean column: rows that are scored but never learned from.
    ``prior`` is the weight, in pieces, of the existing scores.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    ship_package(spark)
    docs = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias("text"),
                       F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"))
    train = docs.filter(~F.col("held_out"))
    langs = [r["lang"] for r in train.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(CLASSES).collect()]
    k = max(len(langs), 1)
    z = reduce(lambda c, i: c.when(F.col("lang") == langs[i], i), range(k - 1), F.when(F.lit(False), 0)).otherwise(k - 1)
    per = [f"c{i}" for i in range(k)]
    words = materialize(docs.select("text", F.when(~F.col("held_out"), z).alias("z")).mapInArrow(_count, "word binary, z int, c long")
                        .groupBy("word").agg(*(F.sum(F.when(F.col("z") == i, F.col("c")).otherwise(0)).alias(per[i]) for i in range(k))), "lm_words")
    ended = {r["z"]: r["n"] for r in train.groupBy(z.alias("z")).agg(F.count("*").alias("n")).collect()}
    ended = np.array([ended.get(i, 0) for i in range(k)])
    ends = int(ended.sum())
    every = words.withColumn("c", reduce(Column.__add__, map(F.col, per)))
    got = np.array([x or 0 for x in every.agg(*(f(F.col(c)) for c in ["c", *per] for f in (
        F.sum, lambda x: F.count_if(x > 0), lambda x: F.count_if(x == 1), lambda x: F.count_if(x == 2)))).first()]).reshape(k + 1, 4)
    known = every.filter("c > 0").select("word", *per)
    total, distinct = int(got[0][0]) + ends, int(got[0][1]) + bool(ends)
    cut = np.array([discount_of(*row[2:].tolist()) for row in got])
    stats = Words(int(got[0][0]), cut[0], cut[0] * got[0][1] + 1, SHARED if k > 1 else 0.0,
                  got[1:, 0] + ended, cut[1:], cut[1:] * got[1:, 1] + 1)

    names = sorted(pieces)
    first = np.array([p[:1] == b" " for p in names] + [False])
    weight = np.exp(np.array([pieces[p] for p in names]))
    weight = np.append(weight, weight.sum() / 4)        # of the prior: a stop after four pieces
    weight /= weight.sum()
    logp = normalized(weight, first)
    tables = [logp] * k
    for _ in range(rounds if got[0][1] else 0):
        model = sc.broadcast((names, logp))
        own = np.zeros((k, len(weight)))
        own[:, -1] = got[1:, 1]
        for r in (known.mapInArrow(_expect(model, k), "z int, piece int, expected double")
                  .groupBy("z", "piece").agg(F.sum("expected").alias("expected")).toLocalIterator()):   # at most a row a class and piece
            own[r["z"], r["piece"]] = r["expected"]
        count = prior * weight + own.sum(axis=0)
        logp = normalized(count, first)
        tables = [normalized(row + CLASS_PRIOR * count / count.sum(), first) for row in own] if k > 1 else [logp]
    logs = [f"lp{i}" for i in range(k)]
    scored = materialize(words.mapInArrow(_score(sc.broadcast((names, logp, tables)), stats),
                                          "word binary, c long, h long, " + ", ".join(f"{x} double" for x in logs)), "lm_scored")

    least = max(1, total >> FREQUENT_BITS)
    top = scored.filter(F.col("c") > least).select(
        F.when(F.length("word") <= FREQUENT_BYTES, F.col("word")).alias("word"), "h", "c", *logs).collect()
    c = np.array([r["c"] for r in top], np.float64)
    below = math.log10(total + distinct + 1)
    frequent = sc.broadcast(({bytes(r["word"]) if r["word"] is not None else b" " + struct.pack(">q", r["h"]): i for i, r in enumerate(top)}, np.log10(c + 1) - below,
                             np.array([r[3:] for r in top]).reshape(len(top), k), (c > 0).astype(np.int64)))
    rows = materialize(docs.select("doc_id", "held_out", "text").mapInArrow(
        _documents(frequent), "doc_id long, held_out boolean, n_tokens long, known long, base double, lp array<double>, "
        "rare array<long>, times array<long>").withColumn("row", F.monotonically_increasing_id()), "lm_rows")
    rare = (rows.select("row", F.explode(F.arrays_zip(F.col("rare").alias("h"), F.col("times").alias("n"))).alias("x"))
            .select("row", "x.h", "x.n")
            .join(scored.select("h", "c", *logs), "h")
            .groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
                                F.sum(F.col("n") * (F.log10(F.col("c") + 1) - below)).alias("rare_base"),
                                *(F.sum(F.col("n") * F.col(x)).alias(x) for x in logs)))
    end_base = math.log10(ends + 1) - below
    # by class: its share of the training rows, an end, the words
    start = np.log10((ended + 1) / (ends + k)) + np.log10((ended + 1) / (stats.totals + 2))
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return (rows.drop("rare", "times").join(rare, "row", "left")
            .withColumn("logs", F.array(*(F.col("lp")[i] + zero(logs[i]) + float(start[i]) for i in range(k))))
            .withColumn("best", F.array_max("logs"))
            .select("doc_id", "held_out", "n_tokens",
                    (F.col("known") + zero("rare_known") + int(ends > 0)).cast("long").alias("n_known"),
                    F.lit(total).cast("long").alias("train_tokens"),
                    (F.col("base") + zero("rare_base") + end_base).alias("base_score"),
                    (F.col("best") + F.log10(F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.pow(F.lit(10.0), x - F.col("best"))))).alias("score")))
