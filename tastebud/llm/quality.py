"""Quality classifier: supervised subword embeddings.

Each document is the average of learned vectors: one a word, one a character
n-gram of the word (with word-boundary marks), one a pair of neighbouring
words, all looked up by hash in one table, plus one mark for a word that
repeats its neighbour.  A softmax layer turns the average into class
probabilities.  Training is plain numpy stochastic gradient descent on a
bounded sample of labelled rows: at most ``sample`` rows a class, those of the
smallest id hash; labels, language, source and id are never inputs.

The layer is linear, so a trained model collapses to one number per table row:
scoring a text of any length sums those numbers and takes no more memory than
the text.  All texts are scored whole.

Null or empty text: the score of the bias alone, i.e. the class shares in the
sample.  A null id never has a label.  Ids with several labels use the lowest.
Repeated rows are scored apiece.  Without labels of both classes every score is
the share of good labels (0.5 without any).  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MEMO_WORDS, mix64, ship_package

BITS = 18               # rows of the table: 2**BITS
WIDTH = 10              # of a vector
GRAMS = (3, 4)          # lengths of character n-grams, in bytes
BLOCK_WORDS = 100_000   # words looked up together
LEAST_STEPS = 6_000     # of training, however few the rows


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def word_rows(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words; the table rows of all words and their character n-grams, and whose they are."""
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    joined = np.frombuffer(b"".join(b"<" + w + b">" for w in words), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)) + 2)
    rows, owners = [_slots(hashes)], [np.arange(len(words))]
    for k in GRAMS:
        n = len(joined) - k + 1
        if n > 0:
            inside = owner[:n] == owner[k - 1 :]
            g = np.full(n, k, np.uint64)
            for j in range(k):
                g = g * np.uint64(0x9E3779B97F4A7C15) + joined[j : n + j] + np.uint64(1)
            rows.append(_slots(mix64(g[inside])))
            owners.append(owner[:n][inside])
    return hashes, np.concatenate(rows), np.concatenate(owners)


REPEAT = int(_slots(mix64(np.array([0x5245504541540001], np.uint64)))[0])


def pair_rows(hashes: np.ndarray) -> np.ndarray:
    """Table rows of neighbouring words; equal neighbours share one row."""
    if len(hashes) < 2:
        return np.zeros(0, np.int64)
    pairs = _slots(mix64(hashes[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[1:]))
    return np.where(hashes[:-1] == hashes[1:], REPEAT, pairs)


def features(text: bytes | None) -> np.ndarray:
    """All table rows of a text, repeats included."""
    words = (text or b"").split()
    if not words:
        return np.zeros(0, np.int64)
    distinct = {w: i for i, w in enumerate(dict.fromkeys(words))}
    hashes, rows, owners = word_rows(list(distinct))
    at = np.fromiter(map(distinct.__getitem__, words), np.int64, len(words))
    times = np.bincount(at)
    return np.concatenate([np.repeat(rows, times[owners]), pair_rows(hashes[at])])


def train(rows: list[tuple[bytes | None, int]], epochs: int = 6, rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """(number of each table row, bias): log odds of label 1 are the mean number of a text's rows plus the bias."""
    good = sum(y for _, y in rows)
    if not 0 < good < len(rows):
        share = (good + 1e-6) / (len(rows) + 2e-6)
        return np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))) if rows else 0.0
    rng = np.random.default_rng(seed)
    docs = []
    for text, y in rows:
        at, n = np.unique(features(text), return_counts=True)
        docs.append((at, (n / max(1, n.sum())).astype(np.float32), y))
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((2, WIDTH), np.float32), np.zeros(2, np.float32)
    steps = max(epochs * len(docs), LEAST_STEPS)
    for step in range(steps):
        if step % len(docs) == 0:
            order = rng.permutation(len(docs))
        at, share, y = docs[order[step % len(docs)]]
        now = rate * (1 - step / steps)
        mean = share @ vectors[at]
        z = out @ mean + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y] -= 1                                   # gradient of the logits
        back = out.T @ p
        out -= now * np.outer(p, mean)
        bias -= now * p * 0.1
        # every row of a text moves by its share of the text, raised so that rare rows learn
        vectors[at] -= now * np.outer(share * min(len(at), 50), back)
    return vectors @ (out[1] - out[0]), float(bias[1] - bias[0])


class WordNumbers:
    """Per distinct word: hash, sum and count of its rows' numbers; emptied at MEMO_WORDS words."""

    def __init__(self, number: np.ndarray) -> None:
        self.number, self.at, self.cols = number, {}, None

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at = self.at
        new = [w for w in dict.fromkeys(words) if w not in at]
        if new:
            if len(at) + len(new) > MEMO_WORDS:
                at.clear()
                self.cols, new = None, list(dict.fromkeys(words))
            hashes, rows, owners = word_rows(new)
            cols = (hashes, np.bincount(owners, self.number[rows], len(new)), np.bincount(owners, minlength=len(new)))
            at.update(zip(new, range(len(at), len(at) + len(new)), strict=True))
            self.cols = cols if self.cols is None else tuple(np.concatenate(x) for x in zip(self.cols, cols, strict=True))
        own = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
        return tuple(c[own] for c in self.cols)


def text_scores(texts: list[bytes | None], memo: WordNumbers, bias: float) -> np.ndarray:
    """Probability of label 1 for each text."""
    out, held, size = [], [], 0

    def flush() -> None:
        hashes, sums, counts = memo.of([w for words in held for w in words])
        ends = np.cumsum([len(words) for words in held])
        for words, z in zip(held, ends, strict=True):
            a = z - len(words)
            pairs = pair_rows(hashes[a:z])
            total = sums[a:z].sum() + memo.number[pairs].sum(dtype=np.float64)
            out.append(total / max(1, counts[a:z].sum() + len(pairs)) + bias)

    for text in texts:
        held.append((text or b"").split())
        size += len(held[-1])
        if size > BLOCK_WORDS:
            flush()
            held, size = [], 0
    if any(held):
        flush()
    else:
        out += [bias] * len(held)
    return 1 / (1 + np.exp(-np.clip(np.array(out, np.float64), -500, 500)))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, bias = model.value
        memo = WordNumbers(number)
        for batch in batches:
            score = text_scores(batch.column(2).to_pylist(), memo, bias)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["doc_id", "held_out", "score"])
    return run


def _accepted(model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, bias = model.value
        memo = WordNumbers(number)
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield batch.filter(pa.array(text_scores(texts, memo, bias) >= least))
    return run


def sample_of(docs: DataFrame, labels: DataFrame, sample: int, longest: int) -> list[tuple[bytes | None, int]]:
    """At most ``sample`` labelled rows a class, by id hash; texts over ``longest`` bytes are scored, not learned from.

    Ids are chosen first, so only the chosen rows' texts leave the scan.
    """
    labels = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    ids = docs.filter(F.length("text") <= longest).select("doc_id").join(labels, "doc_id")
    rows = []
    for y in (0, 1):
        part = ids.filter((F.col("quality") > 0) == F.lit(bool(y)))
        chosen = [r["doc_id"] for r in part.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect()]
        own = docs.filter((F.length("text") <= longest) & F.col("doc_id").isin(chosen))     # repeated ids: limited again
        rows += [(r["text"], y) for r in own.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).select("text").limit(sample).collect()]
    return rows


def fitted(docs: DataFrame, labels: DataFrame, held: Column, sample: int, longest: int):
    """A broadcast model, from rows that ``held`` doesn't mark."""
    ship_package(docs.sparkSession)
    docs = docs.filter(~F.coalesce(held, F.lit(False))).select("doc_id", F.col("text").cast("binary").alias("text"))
    return docs.sparkSession.sparkContext.broadcast(train(sample_of(docs, labels, sample, longest)))


def quality_scores(docs: DataFrame, labels: DataFrame, held: Column, sample: int = 1500, longest: int = 32_768) -> DataFrame:
    """doc_id, held_out, score (probability of label 1), predicted for every row of ``docs``.

    ``held`` is a Boolean column: rows whose labels are never read.  The fit
    reads at most 2 * ``sample`` texts of at most ``longest`` bytes: 100 MB.
    """
    model = fitted(docs, labels, held, sample, longest)
    rows = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return (rows.mapInArrow(_scores(model), "doc_id long, held_out boolean, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def accepted(docs: DataFrame, labels: DataFrame, held: Column, least: float = 0.5, sample: int = 1500, longest: int = 32_768) -> DataFrame:
    """``docs``, all columns, without the rows that score below ``least``: a filter, no join."""
    return docs.mapInArrow(_accepted(fitted(docs, labels, held, sample, longest), least), docs.schema)
