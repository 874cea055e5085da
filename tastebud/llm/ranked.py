"""Ranked lexical search: accumulator-limited, a term at a time.

Terms are the maximal matches of ``TERM`` in the whole text, with A-Z alone in
lower case.  N documents hold a term, L terms are in them, n in one document;
df documents hold a term, tf times in one.  With w = floor(1000 * ln((2N + 2) /
(2df + 1))) in doubles and, in integers, m = 10 + (90 * n * N) div L, a document
scores the sum of w * ((10^9 * tf) div (1000 * tf + 8 * m)) over the item's
distinct terms.

**Plan.**  One pass over the texts writes for every document n and the numbers
and counts of its terms that any item uses; texts are not shuffled.  N, L and df
are aggregates of that table.  A second pass reads it in shards of about
``SHARD`` postings, inverts each shard and ranks every item there; the shards'
best ``k`` are ranked once more.  A document lies in one shard, so the best of
all are among the best of the shards.

**Accumulators.**  Within a shard an item's terms come rarest first, and each has
the largest score that it gives there as its bound.  As soon as the bounds of
the terms to come add up to less than the k-th best partial score, no new
document can be among the best (nor tie with them): no accumulator is created any
more, those that can still reach the k-th score are found in the remaining
lists by binary search, and their scores end exact.

**Items** are the stated query set.  They are taken in blocks by hash, each with
about ``BLOCK_TERMS`` (item, term) pairs, whose terms are broadcast.

Results that are defined for odd input: a null or empty text has no terms, is
not counted in N and is never returned; an item without terms or without a
matching document gives no rows; rows with one ``item_id`` (null included) are
one item with the terms of all of them; repeated document rows count and rank
each; a null ``doc_id`` comes last among equal scores; empty tables give no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, lower_az, materialize, ship_package

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: (item, term) pairs of a block of items; their terms are what is broadcast at once
BLOCK_TERMS = 250_000
#: postings of a shard, held and inverted by one task at once
SHARD = 2_000_000
RESULT = "item_id long, rank int, doc_id long, score long"

#: octets outside terms become spaces, A-Z small letters
_FOLD = bytes(ord(LOWER[UPPER.index(chr(b))]) if chr(b) in UPPER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclass
class Queries:
    """A block of items: their ids, term numbers and, once counted, the terms' weights and document counts."""
    vocabulary: dict[bytes, int]
    ids: list[int | None]
    terms: list[np.ndarray]
    weight: np.ndarray | None = None
    df: np.ndarray | None = None
    documents: int = 0
    occurrences: int = 0


def _postings(asked) -> object:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = asked.value.vocabulary
        for batch in batches:
            n, terms, counts = [], [], []
            for text in batch.column("text"):
                found = Counter(terms_of(text.as_py()))
                n.append(found.total())
                held = [(known[t], c) for t, c in found.items() if t in known]
                terms.append([t for t, _ in held])
                counts.append([c for _, c in held])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))],
                ["doc_id", "n", "terms", "tf"])
    return run


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Shard:
    """Inverted lists of some documents with the score that each posting gives."""

    def __init__(self, batches: list[pa.RecordBatch], asked: Queries):
        ids = [b.column("doc_id") for b in batches]
        self.missing = np.concatenate([i.is_null().to_numpy(zero_copy_only=False) for i in ids])
        self.ids = np.concatenate([i.fill_null(0).to_numpy() for i in ids])
        n = [x for b in batches for x in b.column("n").to_pylist()]
        size = np.array([10 + 90 * x * asked.documents // asked.occurrences for x in n], np.int64)   # Python's integers do not wrap
        lens = np.concatenate([b.column("terms").value_lengths().to_numpy() for b in batches])
        term = np.concatenate([b.column("terms").flatten().to_numpy() for b in batches])
        tf = np.concatenate([b.column("tf").flatten().to_numpy() for b in batches])
        doc = np.repeat(np.arange(len(n)), lens)
        gives = asked.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * size[doc]))
        order = np.argsort(term, kind="stable")       # documents stay ascending within a list
        self.doc, self.gives = doc[order], gives[order]
        self.starts = np.searchsorted(term[order], np.arange(len(asked.weight) + 1))
        self.asked = asked

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[term], self.starts[term + 1])
        return self.doc[at], self.gives[at]

    def best(self, terms: np.ndarray, k: int) -> tuple[list[tuple[int, int]], int]:
        """(document, score) of the k best, and how many documents got an accumulator."""
        terms = [t for t in terms[np.argsort(self.asked.df[terms], kind="stable")].tolist()
                 if self.asked.weight[t] > 0 and self.starts[t] < self.starts[t + 1]]
        bounds = [int(self.list_of(t)[1].max()) for t in terms]
        to_come = sum(bounds)
        score, alive, least, made = np.zeros(len(self.ids), np.int64), None, 0, 0
        for t, bound in zip(terms, bounds, strict=True):
            doc, gives = self.list_of(t)
            to_come -= bound
            if alive is None:
                score[doc] += gives
                if len(score) >= k and to_come < score.max() and to_come < (least := int(np.partition(score, -k)[-k])):
                    made = int(np.count_nonzero(score))
                    alive = np.flatnonzero(score + to_come >= least)
            else:
                at = np.minimum(np.searchsorted(doc, alive), len(doc) - 1)
                hit = doc[at] == alive
                score[alive[hit]] += gives[at[hit]]
        if alive is None:
            alive = np.flatnonzero(score)
            made = len(alive)
        alive = alive[score[alive] > 0]
        order = np.lexsort((self.ids[alive], self.missing[alive], -score[alive]))[:k]
        return [(int(d), int(score[d])) for d in alive[order]], made


def _ranked(asked, k: int):
    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
        held, postings = [], 0
        for batch in batches:
            held.append(batch)
            postings += len(batch.column("terms").flatten())
            if postings >= SHARD:
                yield held
                held, postings = [], 0
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = asked.value
        for held in shards(batches):
            shard = Shard(held, of)
            rows = [(item, None if shard.missing[d] else int(shard.ids[d]), score)
                    for item, terms in zip(of.ids, of.terms, strict=True) for d, score in shard.best(terms, k)[0]]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], ["item_id", "doc_id", "score"])
    return run


def _asked(block: DataFrame) -> Queries:
    """The items of a block, with terms numbered in order."""
    items: dict[int | None, list[bytes]] = {}
    for item, term in block.collect():        # about BLOCK_TERMS rows
        items.setdefault(item, []).append(term.encode())
    vocabulary = {t: i for i, t in enumerate(sorted({t for ts in items.values() for t in ts}))}
    return Queries(vocabulary, list(items), [np.array(sorted(vocabulary[t] for t in ts), np.int64) for ts in items.values()])


def _best_of(docs: DataFrame, asked: Queries, k: int) -> DataFrame:
    spark = docs.sparkSession
    postings = materialize(docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        _postings(spark.sparkContext.broadcast(asked)), "doc_id long, n long, terms array<int>, tf array<long>").filter("n > 0"), "ranked_postings")
    asked.documents, asked.occurrences = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    asked.df = np.zeros(len(asked.vocabulary), np.int64)
    for term, df in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():   # a row a term of the block
        asked.df[term] = df
    asked.weight = np.array([weight(asked.documents, df) for df in asked.df.tolist()], np.int64)
    counted = spark.sparkContext.broadcast(asked)
    return postings.mapInArrow(_ranked(counted, k), "item_id long, doc_id long, score long")


def top_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text)."""
    spark = docs.sparkSession
    ship_package(spark)
    pairs = materialize(items.select("item_id", F.explode(F.regexp_extract_all(lower_az(F.col("text")), F.lit(TERM), F.lit(0))).alias("term"))
                        .distinct(), "ranked_items")
    blocks = math.ceil(pairs.count() / BLOCK_TERMS)
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for b in range(blocks):
        block = pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        if not block.isEmpty():
            found = found.unionByName(_best_of(docs, _asked(block), k))
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
