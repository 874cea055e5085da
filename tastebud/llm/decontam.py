"""Benchmark decontamination: rare word-pair seeds, then Smith-Waterman alignment.

Test items are a stated query set.  They are taken in blocks of at most
``BLOCK_WORDS`` words (one broadcast of bounded size each), so any number of
items runs in bounded memory; every block reads all documents.

* Words are lower-cased (letters beyond A-Z too) and lose punctuation at both
  ends.  A seed is a place of an item: its word with the next one or the one
  after, found in a document with at most one word between.
* An alignment of M equal words at a cost of E others scores 2M - E, so of its
  M - 1 steps from one equal word to the next at least ``least * size - 1``
  cost one or nothing, and each of these is a seed.  All lie on diagonals that
  differ by at most ``2 * size * (1 - least)``.  An item may therefore do
  without its commonest places, as many as leave a third of that number to
  be found near each other: no alignment that scores ``least`` is missed,
  however its edits are spread.  Counts of pairs over all documents
  choose these places and change no score.
* Where a document holds enough seeds of an item, the passage around them is
  aligned with the whole item by Smith-Waterman over words: +2 for an equal
  word, -1 for another word or a gap.  ``score`` is the best alignment over
  the score of a perfect copy, so an edited or partly copied item keeps most
  of it.  Seeds far apart in a document make passages of their own.

Null or empty texts, on either side, give no row.  Items of fewer than ``n``
words have the whole item as their one seed.  Repeated rows are searched
apiece, a null id is carried as null, ties go to the first passage.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MEMO_WORDS, mix64, ship_package, words_of

BLOCK_WORDS = 1_000_000     # of items in one broadcast
TOGETHER = 200_000          # words of documents looked up at once
EDGES = b".,;:!?\"'()[]{}<>*#%&$|/\\-_=+~`^"
SCHEMA = "doc_id long, item_id long, score double, matched long, item_words long, start_word long, end_word long, seeds long"


def plain(word: bytes) -> bytes:
    """A word of ``words_of`` without punctuation at its ends; letters beyond A-Z are lower-cased as well."""
    word = word.strip(EDGES) or word
    return word if word.isascii() else word.decode(errors="surrogateescape").lower().encode(errors="surrogateescape")


class BlockWords(dict):
    """Numbers of the words that a block's items have; other words are 0."""

    def __init__(self, numbers: dict[bytes, int]) -> None:
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        k = self[word] = self.numbers.get(plain(word), 0)
        return k


#: multipliers of a window's words; exact equality of windows is confirmed by the alignment
FACTORS = mix64(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
PAIR = np.uint64(0x5851F42D4C957F2D)    # keeps hashes of pairs apart from those of whole short items


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n-gram of word numbers; windows with a foreign word are 0."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    size = len(ids) - n + 1
    h, own = np.zeros(size, np.uint64), np.ones(size, bool)
    for k in range(n):
        part = ids[k : size + k]
        h += part.astype(np.uint64) * FACTORS[k % 64]
        own &= part > 0
    h[~own] = 0
    return h


def pairs(ids: np.ndarray, step: int) -> np.ndarray:
    """A hash for each word with the one ``step`` places on; 0 where either is foreign."""
    if len(ids) <= step:
        return np.zeros(0, np.uint64)
    left, right = ids[:-step], ids[step:]
    h = (left.astype(np.uint64) * FACTORS[0] + right.astype(np.uint64) * FACTORS[1]) ^ PAIR
    h[(left == 0) | (right == 0)] = 0
    return h


def together(texts: list[bytes | None], words: BlockWords) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Word numbers of several texts in one array, two 0 after each text, and where each text starts (and the last ends)."""
    held, starts = [], [0]
    for text in texts:
        own = [words[w] for w in words_of(text)]
        held += own
        held += (0, 0)      # no pair reaches over them
        starts.append(len(held))
        if len(held) > TOGETHER:
            yield np.array(held, np.int64), np.array(starts)
            held, starts = [], [0]
    if len(starts) > 1:
        yield np.array(held, np.int64), np.array(starts)


class Block:
    """The items of one block: word numbers, and the hashes at each of their places."""

    def __init__(self, items: list[tuple[int | None, bytes]], n: int, least: float) -> None:
        numbers, self.items = {}, []
        for item_id, text in items:
            words = [plain(w) for w in words_of(text)]
            if words:
                self.items.append((item_id, np.array([numbers.setdefault(w, len(numbers) + 1) for w in words], np.int64)))
        self.numbers = numbers
        size = np.array([len(ids) for _, ids in self.items], np.int64)
        #: places that any alignment must hit, and how far apart their diagonals can be
        self.need = np.ceil(least * size - 1e-9).astype(np.int64) - 1
        self.reach = np.maximum(0, np.floor(2 * size * (1 - least) + 1e-9).astype(np.int64))
        self.places, spans = [], set()      # for each item (hash, place)
        for k, (_, ids) in enumerate(self.items):
            if len(ids) < n:                # the whole item
                found = [(grams(ids, len(ids)), len(ids))]
            elif self.need[k] < 1:          # so low a ``least`` that one word is enough
                found = [(grams(ids, 1), 1)]
            else:
                found = [(pairs(ids, 1), 0), (pairs(ids, 2), 0)]
            spans |= {span for _, span in found}
            self.places.append(sorted({(int(h), p) for own, _ in found for p, h in enumerate(own)}))
            if len(ids) < n or self.need[k] < 1:
                self.need[k] = 1
        self.sizes = sorted(spans)          # 0 stands for pairs
        self.keys = np.unique(np.array([h for own in self.places for h, _ in own], np.uint64))

    def hits(self, ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a document and the numbers of the sorted ``keys`` that stand there."""
        at, which = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for h in [x for size in self.sizes for x in ((grams(ids, size),) if size else (pairs(ids, 1), pairs(ids, 2)))]:
            where = np.flatnonzero(h)
            k = np.minimum(np.searchsorted(keys, h[where]), max(len(keys) - 1, 0))
            hit = keys[k] == h[where]
            at.append(where[hit])
            which.append(k[hit])
        return np.concatenate(at), np.concatenate(which)

    def seeds(self, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """(keys, first entry of each key, item and place of the entries, places needed of each item).

        ``count`` (of each of ``self.keys``) chooses the places that an item does without.
        """
        entries, need = [], self.need.copy()
        for k, own in enumerate(self.places):
            cost: dict[int, int] = {}
            number = np.searchsorted(self.keys, np.array([h for h, _ in own], np.uint64))
            for (_, p), c in zip(own, count[number], strict=True):
                cost[p] = cost.get(p, 0) + int(c)
            spare = int(need[k]) * 2 // 3 if len(cost) > 1 else 0
            need[k] -= spare
            without = set(sorted(cost, key=lambda p: (-cost[p], p))[:spare])
            entries += [(h, k, p) for h, p in own if p not in without]
        entries.sort()
        keys, first = np.unique(np.array([e[0] for e in entries], np.uint64), return_index=True)
        return (keys, np.r_[first, len(entries)], *(np.array([e[i] for e in entries], np.int64) for i in (1, 2)), need)


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local score (+2 equal, -1 other, -1 gap), and the passage's words (first, past the last)."""
    m = len(passage)
    ramp = np.arange(1, m + 1)
    prev, origin = np.zeros(m + 1, np.int64), np.arange(m + 1)
    best = (0, 0, 0)
    for word in item:
        step = prev[:-1] + np.where(passage == word, 2, -1)
        down = prev[1:] - 1
        score = np.maximum(np.maximum(step, down), 0)
        start = np.where(score == 0, ramp, np.where(score == step, origin[:-1], origin[1:]))
        # gaps in the passage: the running best of score + position, less the position
        lifted = np.r_[0, score] + np.arange(m + 1)
        run = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == run, np.arange(m + 1), 0))
        prev = run - np.arange(m + 1)
        start = np.r_[0, start]
        origin = start[source]
        top = int(prev.argmax())
        if prev[top] > best[0]:
            best = (int(prev[top]), int(origin[top]), top)
    return best


def _count(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = block.value
        words, total = BlockWords(b.numbers), np.zeros(len(b.keys), np.int64)
        for batch in batches:
            for ids, _ in together(batch.column(0).to_pylist(), words):
                total += np.bincount(b.hits(ids, b.keys)[1], minlength=len(b.keys))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["key", "times"])
    return run


def leaks(texts: list[bytes | None], words: BlockWords, b: Block, seeds: tuple[np.ndarray, ...], least: float) -> Iterator[list[tuple]]:
    """For each text a list of (item_id, score, matched, item_words, start_word, end_word, seeds), an entry for each item it holds."""
    for ids, starts in together(texts, words):
        held: list[list[tuple]] = [[] for _ in starts[1:]]
        for text, item, diagonals in near_seeds(ids, starts, b, seeds):
            row = aligned(ids[starts[text] : starts[text + 1] - 2], diagonals - starts[text], b, item, least)
            if row:
                held[text].append(row)
        yield from held


def near_seeds(ids: np.ndarray, starts: np.ndarray, b: Block, seeds: tuple[np.ndarray, ...]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, item, sorted diagonals of its seeds) where a text holds as many seeds of an item as needed, near each other."""
    keys, first, items, places, need = seeds
    at, key = b.hits(ids, keys)
    times = first[key + 1] - first[key]
    entry = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times - first[key], times)
    at = np.repeat(at, times)
    text, item, place = np.searchsorted(starts, at, "right") - 1, items[entry], places[entry]
    diagonal = at - place
    order = np.lexsort((place, diagonal, item, text))
    text, item, place, diagonal = text[order], item[order], place[order], diagonal[order]
    if not len(order):
        return
    # a place that both pairs of a word find counts once
    own = np.r_[True, (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) != 0) | (np.diff(place) != 0)]
    text, item, diagonal = text[own], item[own], diagonal[own]
    here = np.arange(len(text))
    last = here + need[item] - 1
    end = np.minimum(last, len(text) - 1)
    enough = (last < len(text)) & (text[end] == text) & (item[end] == item) & (diagonal[end] - diagonal <= b.reach[item])
    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, here[enough], 1)
    np.add.at(cover, last[enough] + 1, -1)
    keep = np.cumsum(cover[:-1]) > 0
    text, item, diagonal = text[keep], item[keep], diagonal[keep]
    cut = np.flatnonzero((np.diff(text) != 0) | (np.diff(item) != 0)) + 1
    for lo, hi in zip(np.r_[0, cut], np.r_[cut, len(text)], strict=True):
        if lo < hi:
            yield int(text[lo]), int(item[lo]), diagonal[lo:hi]


def aligned(ids: np.ndarray, diagonals: np.ndarray, b: Block, item: int, least: float) -> tuple | None:
    """The best alignment of an item in a text of word numbers ``ids`` with seeds on sorted ``diagonals``."""
    item_id, theirs = b.items[item]
    size, reach, best, top = len(theirs), int(b.reach[item]), (0, 0, 0), 0
    # where the item would begin, by its seeds; a wider gap than one alignment has starts another passage
    for part in np.split(diagonals, np.flatnonzero(np.diff(diagonals) > reach) + 1):
        first = max(0, int(part[0]) - reach)
        last = min(len(ids), int(part[-1]) + size + reach + 1)
        got = smith_waterman(theirs, ids[first:last])
        if got[0] > best[0]:
            best, top = got, first
    if best[0] < least * 2 * size:
        return None
    a, z = top + best[1], top + best[2]
    return item_id, best[0] / (2 * size), int(np.isin(theirs, ids[a:z]).sum()), size, a, z, len(diagonals)


def _align(block, seeds, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = BlockWords(block.value.numbers)
        for batch in batches:
            held = leaks(batch.column(1).to_pylist(), words, block.value, seeds.value, least)
            rows = [(doc_id, *x) for doc_id, found in zip(batch.column(0).to_pylist(), held, strict=True) for x in found]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 8
            types = [pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             [f.split()[0] for f in SCHEMA.split(", ")])
    return run


def _clean(block, seeds, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = BlockWords(block.value.numbers)
        for batch in batches:
            texts = [t.encode() if t else None for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            clean = [not found for found in leaks(texts, words, block.value, seeds.value, least)]
            yield batch.filter(pa.array(clean, pa.bool_()))
    return run


def blocks_of(items: DataFrame, n: int, least: float) -> Iterator[Block]:
    """Items in blocks of at most BLOCK_WORDS words (or one longer item)."""
    held, size = [], 0
    for r in items.select("item_id", F.col("text").cast("binary").alias("text")).orderBy("item_id", "text").toLocalIterator():
        words = len(words_of(r["text"]))
        if held and size + words > BLOCK_WORDS:
            yield Block(held, n, least)
            held, size = [], 0
        held.append((r["item_id"], r["text"]))
        size += words
    if held:
        yield Block(held, n, least)


def prepared(docs: DataFrame, items: DataFrame, n: int, least: float) -> Iterator[tuple]:
    """Broadcasts of each block and of its seeds."""
    sc = docs.sparkSession.sparkContext
    ship_package(docs.sparkSession)
    texts = docs.select(F.col("text").cast("binary"))
    for block in blocks_of(items, n, least):
        shared = sc.broadcast(block)
        count = np.zeros(len(block.keys), np.int64)
        for r in (texts.mapInArrow(_count(shared), "key int, times long")
                  .groupBy("key").agg(F.sum("times").alias("times")).toLocalIterator()):   # at most a row a pair of the block
            count[r["key"]] = r["times"]
        yield shared, sc.broadcast(block.seeds(count))


def contaminated(docs: DataFrame, items: DataFrame, n: int = 4, least: float = 0.5) -> DataFrame:
    """A row for each document and item whose alignment scores ``least`` or more.

    doc_id, item_id, score (0 to 1), matched (words of the item in the aligned
    passage), item_words, start_word and end_word of the passage, seeds.
    """
    out = docs.sparkSession.createDataFrame([], SCHEMA)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    for block, seeds in prepared(docs, items, n, least):
        out = out.unionByName(texts.mapInArrow(_align(block, seeds, least), SCHEMA))
    return out


def decontaminated(docs: DataFrame, items: DataFrame, n: int = 4, least: float = 0.5) -> DataFrame:
    """``docs``, all columns, without the rows whose text holds a test item: a filter, no join."""
    out = docs
    for block, seeds in prepared(docs, items, n, least):
        out = out.mapInArrow(_clean(block, seeds, least), docs.schema)
    return out
