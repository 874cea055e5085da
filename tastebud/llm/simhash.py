"""SimHash near-duplicates, found by covering locality-sensitive hashing.

A text's fingerprint has 64 bits: bit i is 1 if it is set in over half of the
XXH64 hashes (seed 42) of its ``width``-word shingles, repeats included.  Two
fingerprints link at ``radius`` or fewer differing bits.

**Covering.**  Every bit place i carries a nonzero vector phi(i) of radius + 1
bits.  Table v (any nonzero vector of that length) keeps the bits whose phi has
an odd product with v and clears the others.  The phi of ``radius`` differing
places span at most ``radius`` dimensions, so some v is orthogonal to all of
them: its table clears every differing place and the pair shares a bucket
there.  2^(radius + 1) - 1 tables therefore miss no pair; each keeps about half
of the 64 bits, so unrelated fingerprints rarely meet.

**Buckets.**  Equal fingerprints are one class.  A bucket's members are
compared in one sweep that emits a spanning forest, never its pairs: a member
taken from the frontier claims all unclaimed members within the radius.  A
bucket above ``BLOCK`` members is cut into blocks by hash and swept for every
two of its blocks, so each task holds at most 2 * BLOCK fingerprints.  Keys that
hold over 1/1,024 of all rows are joined by broadcast (there are fewer than
1,024 of them), all others by shuffle.

Results that are defined for odd input: a null, empty or white-space text has
fingerprint zero, which links like any other; fewer than ``width`` words are one
shingle; whole texts count, however long; a null ``doc_id`` gets its row and is
never a component's id unless no member has one (then null); repeated rows each
get theirs; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, ship_package, words_of

BITS = 64
#: fixed value: the seed of the shingles' hashes
SEED = 42
#: members of a bucket compared in one sweep; larger buckets are cut
BLOCK = 2048
#: shingle hashes held at once while a text's bits are counted
CHUNK = 65_536
#: a key with over 1/HOT of all rows is joined by broadcast; there are fewer than HOT
HOT = 1024


def fingerprint(words: list[bytes], width: int) -> int:
    """Unsigned fingerprint of a word list; 0 without words."""
    if not words:
        return 0
    lens = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lens + 1) - 1
    span = min(width, len(words))
    starts, ends, n = ends - lens, ends[span - 1:], len(words) - span + 1
    text, counts = b" ".join(words), np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        to = min(n, at + CHUNK)
        hashes = [xxhash.xxh64_intdigest(text[s:e], SEED) for s, e in zip(starts[at:to].tolist(), ends[at:to].tolist(), strict=True)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def covering_masks(radius: int) -> list[int]:
    """The kept bits of each table: 2^(radius + 1) - 1 masks of 64 bits."""
    vectors = range(1, 2 ** (radius + 1))
    phi = [vectors[i % len(vectors)] for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (v & phi[i]).bit_count() % 2) for v in vectors]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed 64-bit values (``bitwise_count`` of a negative one would count its absolute value)."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(members: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (a, b) that join exactly what all pairs within ``radius`` would join."""
    links, left, frontier = [], members, []
    while len(left) or frontier:
        if not frontier:
            frontier, left = [left[0]], left[1:]
            continue
        x = frontier.pop()
        near = apart(left, x) <= radius
        if near.any():
            found, left = left[near], left[~near]
            links += [(int(x), int(y)) for y in found]
            frontier += list(found)
    return links


def _prints(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(words_of(t.as_py()), width) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])
    return run


def _forests(radius: int):
    """Links of the buckets of a partition that is sorted by (tab, key, lo, hi); one bucket is held at a time."""
    names = ("tab", "key", "lo", "hi")

    def swept(of: list[np.ndarray], prints: np.ndarray) -> pa.RecordBatch:
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in of], axis=0)) + 1
        ends = np.append(cuts, len(prints))
        starts = np.append(0, cuts)
        two = starts[ends - starts == 2]
        two = two[apart(prints[two], prints[two + 1]) <= radius]
        a, b = [prints[two]], [prints[two + 1]]
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            if e - s > 2 and (links := forest(prints[s:e], radius)):
                pairs = np.array(links, np.int64)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, prints = [np.zeros(0, np.int64)] * 4, np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            kept = [np.concatenate([k, batch.column(c).to_numpy()]) for k, c in zip(kept, names, strict=True)]
            prints = np.concatenate([prints, batch.column("print").to_numpy()])
            same = np.all([k == k[-1] for k in kept], axis=0)
            open_ = int(len(same) - np.argmin(same[::-1])) if not same.all() else 0   # the last bucket may go on
            if open_:
                yield swept([k[:open_] for k in kept], prints[:open_])
                kept, prints = [k[open_:] for k in kept], prints[open_:]
        if len(prints):
            yield swept(kept, prints)
    return run


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], n: str) -> DataFrame:
    """``rows`` joined with ``table``, which has one row a key and in ``n`` how many of ``rows`` hold that key."""
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = F.broadcast(table.filter(F.col(n) * HOT > total))
    rest = table.filter(F.col(n) * HOT <= total)
    return rows.join(hot, keys).unionByName(
        rows.join(hot.select(*keys), keys, "left_anti").join(rest, keys))


def _links(classes: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between different fingerprints; their components are those of all pairs within the radius."""
    kept: list[Column] = [F.col("print").bitwiseAND(F.lit(signed(m))) for m in covering_masks(radius)]
    keyed = classes.select("print", F.posexplode(F.array(*kept)).alias("tab", "key"))
    buckets = materialize(keyed.groupBy("tab", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash_buckets")
    cut = (looked_up(keyed, buckets, ["tab", "key"], "n")
           .withColumn("blocks", F.ceil(F.col("n") / BLOCK))
           .withColumn("block", F.pmod(F.xxhash64("print"), F.col("blocks")))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
           .select(F.col("tab").cast("long").alias("tab"), "key", F.least("block", "other").alias("lo"),
                   F.greatest("block", "other").alias("hi"), "print"))
    order = ["tab", "key", "lo", "hi"]
    return cut.repartition(*order).sortWithinPartitions(*order).mapInArrow(_forests(radius), "a long, b long")


def simhash_components(docs: DataFrame, width: int = 5, radius: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs`` (doc_id, text)."""
    ship_package(docs.sparkSession)
    prints = materialize(docs.select("doc_id", F.col("text").cast("binary").alias("text"))
                         .mapInArrow(_prints(width), "doc_id long, print long"), "simhash_prints")
    classes = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "simhash_classes")
    comps = connected_components(_links(classes, radius), "simhash_cc").select(F.col("node").alias("print"), "comp")
    known = materialize(classes.join(comps, "print", "left").withColumn("comp", F.coalesce("comp", "print")), "simhash_known")
    lowest = materialize(known.groupBy("comp").agg(F.min("low").alias("component_id"), F.count("*").alias("size")), "simhash_lowest")
    ids = materialize(looked_up(known, lowest, ["comp"], "size").select("print", "n", "component_id"), "simhash_ids")
    return (looked_up(prints, ids, ["print"], "n")
            .select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id"))
