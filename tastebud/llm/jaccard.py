"""Size-aware heavy-light set join: links between documents of similar word shingles.

Sets that are equal collapse into one class.  A set of at most ``b`` shingles
enumerates its fixed-size subsets: two small sets link when they share a
subset of as many shingles as their sizes ask for.  A larger set scans
inverted lists: of its shingles in an order shared by all documents, rare ones
first, only the leading ones that any partner must hit are looked up.  ``b`` is
the boundary of least cost: subsets written against list entries written and
the lengths of their lists.

* Document counts of shingles are taken over all documents into two tables of
  fixed size, indexed by hash: a bit for "in two documents or more" and the
  logarithm of the largest count.  They order shingles and drop documents that
  too few shared shingles can link; neither changes the result.
* Lists hold numbers of sets and are first joined to one leading member each (one
  row per list entry).  What that links is one component.  Lists that still hold
  several components take other leading members, up to ``ROUNDS`` times, as long
  as that leaves clearly fewer meetings, and still many; only then members of
  *different* components meet inside a list, pruned by size and by a parity
  sketch, whose differing bits are a lower bound of the symmetric difference.  So
  a group of thousands of copies never becomes all its pairs.  Only entries of
  such lists carry sketches; a set has as many bits as its size asks for, and two
  sets meet on the fewer bits, to which the longer sketch folds.
* Every candidate is verified on the whole sets.

Null or empty text: an empty set, linked with nothing.  A null ``doc_id`` takes
part in links; it is the component's id only where all ids are null.  Repeated
rows are kept, one result row each.  Extra columns are ignored.  An empty table
gives no rows; a text of any length is one set in one task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, connected_components, materialize, rolling, ship_package, words_of

FLAG_BITS, CLASS_BITS = 27, 24      # fixed-size tables: 16 MB of bits, 16 MB of bytes
RANGES = 10                         # 2**RANGES hash ranges, counted apart
SKETCH_WORDS = 16                   # 1,024 parity bits a set at most
SKETCH_FILL = 8                     # percent of a sketch's bits that two linked sets may differ in; sets somewhat alike differ in more
ROUNDS = 3                          # leading members that lists take one after another at most
MEETINGS = 20                       # of members of different components, for an entry, beyond which lists take another one
LARGEST_BOUNDARY = 30               # sizes that may enumerate subsets
READS = 20                          # members of a list read at the cost of one entry written
BUFFER = 1_000_000                  # shingles counted together by one map task


def shingle_set(text: bytes | None, width: int, memo: WordHashes) -> np.ndarray:
    return np.unique(rolling(memo.of(words_of(text)), width))


def _packed(h: np.ndarray) -> bytes:
    """Ascending hashes as a byte a hash's width and the gaps: two bytes each, or four bytes each as they are."""
    gaps = np.diff(h)
    if len(h) and gaps.max(initial=0) < 1 << 16:
        return b"\2" + h[:1].astype("<u4").tobytes() + gaps.astype("<u2").tobytes()
    return b"\4" + h.astype("<u4").tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    if packed[0] == 4:
        return np.frombuffer(packed, "<u4", offset=1)
    first, gaps = np.frombuffer(packed, "<u4", 1, offset=1), np.frombuffer(packed, "<u2", offset=5)
    return np.concatenate([first, gaps]).cumsum(dtype=np.uint32)


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as ``_tables`` takes them."""
    for batch in batches:
        plain = [pa.array([_unpacked(x).astype("<u4").tobytes() for x in batch.column(c).to_pylist()], pa.binary()) for c in ("once", "more")]
        yield pa.RecordBatch.from_arrays([batch.column("range"), *plain, batch.column("times")], ["range", "once", "more", "times"])


def _counts(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, held, n = WordHashes(), [], 0

        def flush() -> pa.RecordBatch:
            seen, count = np.unique(np.concatenate(held), return_counts=True)
            cut = np.searchsorted(seen, np.arange(1 << RANGES, dtype=np.uint64) << np.uint64(32 - RANGES))
            rows = []
            for k, (a, b) in enumerate(itertools.pairwise([*cut, len(seen)])):
                if a < b:
                    h, c = seen[a:b], count[a:b]
                    rows.append((k, _packed(h[c == 1]), _packed(h[c > 1]), c[c > 1].astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), *[pa.binary()] * 3))],
                ["range", "once", "more", "times"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                s = shingle_set(text, width, memo) >> np.uint64(32)
                held.append(np.unique(s))
                n += len(s)
                if n >= BUFFER:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()
    return run


def _summed(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return h[first], np.add.reduceat(c, first)


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Flags and levels of one range after another (rows come sorted by range).

    What is held never passes a few times the 2**(32 - RANGES) hashes that a range has, whatever the input.
    """
    now, held, waiting = None, [], 0

    def closed() -> pa.RecordBatch:
        h, c = _summed(*(np.concatenate(x) for x in zip(*held, strict=True)))
        h, c = h[c > 1], c[c > 1]
        bits = np.zeros(1 << (FLAG_BITS - RANGES), np.uint8)
        bits[(h >> np.uint32(32 - FLAG_BITS)) & np.uint32(len(bits) - 1)] = 1
        level = np.zeros(1 << (CLASS_BITS - RANGES), np.uint8)
        np.maximum.at(level, (h >> np.uint32(32 - CLASS_BITS)) & np.uint32(len(level) - 1),
                      np.log2(np.maximum(c, 1)).astype(np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary()),
                                           pa.array([level.tobytes()], pa.binary())], ["range", "flags", "levels"])

    for batch in batches:
        for k, once, more, times in zip(*batch.columns, strict=True):
            k = k.as_py()
            if k != now:
                if held:
                    yield closed()
                now, held, waiting = k, [], 0
            once, more, times = (np.frombuffer(x.as_buffer(), "<u4") for x in (once, more, times))
            held.append((np.concatenate([once, more]), np.concatenate([np.ones(len(once), np.int64), times])))
            waiting += len(held[-1][0])
            if waiting > max(BUFFER, 2 * len(held[0][0])):
                held = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                waiting = 0
    if held:
        yield closed()


def shingle_tables(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bits for shingles of two documents or more, and log2 of the largest count, by hash."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = (docs.select(F.col("text").cast("binary"))
            .mapInArrow(_counts(width), "range int, once binary, more binary, times binary")
            .repartition(parts, "range").sortWithinPartitions("range")
            .mapInArrow(lambda batches: _tables(_opened(batches)), "range int, flags binary, levels binary"))
    flags = np.zeros(1 << (FLAG_BITS - 3), np.uint8)
    levels = np.zeros(1 << CLASS_BITS, np.uint8)
    for r in rows.toLocalIterator():    # 2**RANGES rows at most, 32 MB in all whatever the input
        flags[r["range"] << (FLAG_BITS - 3 - RANGES):][: len(r["flags"])] = np.frombuffer(r["flags"], np.uint8)
        levels[r["range"] << (CLASS_BITS - RANGES):][: len(r["levels"])] = np.frombuffer(r["levels"], np.uint8)
    return flags, levels


def _sets(width: int, percent: int, tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, (flags, levels), seen = WordHashes(), tables.value, set()
        for batch in batches:
            n, node, packed, shared, price = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, width, memo)
                n.append(len(s))
                node.append(None)
                packed.append(None)
                shared.append(None)
                price.append(None)
                if not len(s):
                    continue
                bit = (s >> np.uint64(64 - FLAG_BITS)).astype(np.int64)
                in_two = (flags[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1).astype(bool)
                if 100 * int(in_two.sum()) < percent * len(s):
                    continue    # no partner can share enough
                node[-1] = key = xxhash.xxh128_digest(s.astype("<u8").tobytes())
                if key in seen:
                    continue
                seen.add(key)
                if len(seen) > 200_000:
                    seen.clear()
                level = np.where(in_two, levels[(s >> np.uint64(64 - CLASS_BITS)).astype(np.int64)] + 1, 0)
                order = np.lexsort((s, level))
                shared[-1] = alone = int(len(s) - in_two.sum())
                packed[-1] = s[order][alone:].view(np.int64).tolist()   # the others are in no other set
                lists = level[order][alone : len(s) - math.ceil(len(s) * percent / 100) + 1]
                price[-1] = float((1 + np.exp2(lists - 1.0) / READS).sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(node, pa.binary()),
                 pa.array(packed, pa.list_(pa.int64())), pa.array(shared, pa.int32()), pa.array(price, pa.float64())],
                ["doc_id", "n", "node", "shingles", "alone", "price"])
    return run


def subsets_of(n: int, percent: int) -> int:
    """How many fixed-size subsets a set of ``n`` shingles enumerates."""
    return sum(math.comb(n, k) for k in range(n - math.ceil(n * percent / 100) + 1))


def boundary(sizes: list[tuple[int, int, float]], percent: int) -> int:
    """The largest size that enumerates subsets, at least cost.

    ``sizes`` has (size, sets, cost of their list scans) for sizes up to LARGEST_BOUNDARY.  A scan costs an
    entry written for each leading shingle, and the members of its list, READS of them as much as an entry.
    """
    best, least = 0, math.inf
    for b in range(LARGEST_BOUNDARY + 1):
        cost = sum(c * subsets_of(n, percent) if n <= b else read for n, c, read in sizes)
        # small sets that a larger one can link to are in the lists as well
        cost += sum(read for n, c, read in sizes if n <= b and 100 * n >= percent * (b + 1))
        if cost < least:
            best, least = b, cost
    return best


def sketch_limits(percent: int) -> list[tuple[int, int]]:
    """(words, largest set that has so many) in ascending order; larger sets have ``SKETCH_WORDS``."""
    words = [w for w in (2, 4, 8) if w < SKETCH_WORDS]
    return [(w, 64 * w * SKETCH_FILL * (100 + percent) // max(200 * (100 - percent), 1)) for w in words]


def sketch_of(s: np.ndarray, percent: int, n: int | None = None) -> np.ndarray:
    """Parity of the hashes by their last bits, as whole words; beyond the words of the set's size all zero.

    ``n``: the set's size where ``s`` lacks the shingles that no other set has.
    """
    size = len(s) if n is None else n
    bits = 64 * next((w for w, most in sketch_limits(percent) if size <= most), SKETCH_WORDS)
    parity = np.zeros(64 * SKETCH_WORDS, np.uint8)
    np.bitwise_xor.at(parity, (s & np.uint64(bits - 1)).astype(np.int64), 1)
    return np.packbits(parity).view("<i8")


def apart(percent: int) -> str:
    """SQL of the bits in which the sketches of ``l_`` and ``r_`` differ, both folded to the smaller set's words."""
    differ = [f"l_s{i} ^ r_s{i}" for i in range(SKETCH_WORDS)]

    def folded(words: int) -> str:
        return " + ".join(f"bit_count({' ^ '.join(differ[j::words])})" for j in range(words))

    cases = " ".join(f"WHEN least(l_n, r_n) <= {most} THEN {folded(w)}" for w, most in sketch_limits(percent))
    return f"CASE {cases} ELSE {folded(SKETCH_WORDS)} END"


def _keys(percent: int, b: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sketch = [], []
            for n, shingles, alone in zip(*(batch.column(c).to_pylist() for c in ("n", "shingles", "alone")), strict=True):
                s = np.array(shingles, np.int64).view(np.uint64)
                own = []
                if n <= b:
                    common = s.tolist()   # a subset with a shingle of its own is in no other set
                    for size in range(math.ceil(n * percent / 100), n + 1):
                        own += [xxhash.xxh64_intdigest(np.array(sorted(x), "<u8").tobytes(), seed=size) >> 1
                                for x in itertools.combinations(common, size)]
                if n > b or 100 * n >= percent * (b + 1):
                    lead = n - math.ceil(n * percent / 100) + 1 - alone
                    own += (s[:lead] | np.uint64(1 << 63)).view(np.int64).tolist()   # sign bit: a shingle, not a subset
                keys.append(own)
                sketch.append(sketch_of(s, percent, n).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n"), batch.column("alone"), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sketch, pa.list_(pa.int64()))], ["id", "n", "alone", "keys", "sketch"])
    return run


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("key", *(F.col(c).alias(prefix + c) for c in df.columns if c != "key"))


def _near(percent: int) -> Column:
    """Whether sizes and sketches of ``l_`` and ``r_`` leave room for a link."""
    near = F.expr(f"{apart(percent)} + l_alone + r_alone <= l_n + r_n - 2 * (({percent} * (l_n + r_n) + {99 + percent}) div {100 + percent})")
    return near & F.expr(f"100 * least(l_n, r_n) >= {percent} * greatest(l_n, r_n)")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets are similar enough; only the sets of some pair are read further."""
    pairs = materialize(pairs, "jaccard_pairs")
    sets = sets.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "id", "left_semi")
    a = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(a, "a").join(b, "b").filter(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _with_heads(open_lists: DataFrame, rank: Column) -> DataFrame:
    """Distinct pairs (a, b) of a list's member of highest ``rank`` and its members of other components."""
    head = open_lists.groupBy("key").agg(F.max(F.struct(rank.alias("rank"), "id", "comp")).alias("head"))
    return (open_lists.join(head.select("key", F.col("head.id").alias("h"), F.col("head.comp").alias("h_comp")), "key")
            .filter("comp <> h_comp").select(F.least("id", "h").alias("a"), F.greatest("id", "h").alias("b")).distinct())


def _several(entries: DataFrame, comps: DataFrame) -> DataFrame:
    """Entries (key, id) with ``comp``, of the lists that hold several components."""
    known = entries.select("key", "id").join(comps.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    mixed = known.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key")
    return materialize(known.join(mixed, "key").select("key", "id", "comp"), "jaccard_open")


def _meetings(open_lists: DataFrame) -> float:
    """How many members of other components an entry's list holds, on average."""
    own = open_lists.groupBy("key", "comp").agg(F.count("*").cast("double").alias("c"))
    lists = own.groupBy("key").agg(F.sum("c").alias("m"), F.sum(F.col("c") * F.col("c")).alias("cc"))
    met, entries = lists.agg(F.sum(F.col("m") * F.col("m") - F.col("cc")), F.sum("m")).first()
    return met / entries if entries else 0.0


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their
    sets of distinct ``width``-word shingles.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    tables = spark.sparkContext.broadcast(shingle_tables(docs, width))     # 32 MB at any input size
    rows = materialize(docs.mapInArrow(
        _sets(width, percent, tables), "doc_id long, n long, node binary, shingles array<long>, alone int, price double"), "jaccard_rows")
    sets = materialize(rows.filter("shingles is not null").dropDuplicates(["node"])
                       .select(F.monotonically_increasing_id().alias("id"), "node", "n", "shingles", "alone", "price"), "jaccard_sets")

    sizes = [tuple(r) for r in sets.filter(F.col("n") <= LARGEST_BOUNDARY)
             .groupBy("n").agg(F.count("*"), F.sum("price")).collect()]
    b = boundary(sizes, percent)
    keyed = materialize(sets.select("id", "n", "shingles", "alone").mapInArrow(
        _keys(percent, b), "id long, n long, alone int, keys array<long>, sketch array<long>").filter("size(keys) > 0"), "jaccard_keys")
    sketches = keyed.select("id", "n", "alone", *(F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH_WORDS)))

    entries = keyed.select(F.explode("keys").alias("key"), "id", F.size("keys").alias("weight"))
    shared = entries.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("key")
    entries = materialize(entries.join(shared, "key"), "jaccard_entries")

    def linked(pairs: DataFrame) -> DataFrame:
        for side, end in (("l_", "a"), ("r_", "b")):
            pairs = pairs.join(sketches.select(*(F.col(c).alias(side + c) for c in sketches.columns)), F.col(end) == F.col(f"{side}id"))
        return materialize(_verified(pairs.filter(_near(percent)).select("a", "b"), sets, percent), "jaccard_links")

    open_lists = entries.withColumn("comp", F.col("id"))
    links, before = None, math.inf
    for order in range(ROUNDS):
        # first the least changed of many copies; then any member, another one in each list, so that a set meets many of a component
        found = linked(_with_heads(open_lists, F.xxhash64("id", "key", F.lit(order)) if order else F.col("weight")))
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        open_lists = _several(open_lists, materialize(connected_components(links, "jaccard_cc"), "jaccard_comps"))
        met = _meetings(open_lists)
        if met <= MEETINGS or met > 0.8 * before:
            break
        before = met

    known = materialize(open_lists.join(sketches, "id"), "jaccard_met")
    rest = (_prefixed(known, "l_").join(_prefixed(known, "r_"), "key")
            .filter((F.col("l_comp") != F.col("r_comp")) & (F.col("l_id") < F.col("r_id")) & _near(percent))
            .select(F.col("l_id").alias("a"), F.col("r_id").alias("b")).distinct())
    rest = _verified(rest, sets, percent)
    comps = connected_components(rest if links is None else links.unionByName(rest), "jaccard_cc2")

    ids = sets.select("node", "id").join(comps.withColumnRenamed("node", "id"), "id", "left").select("node", F.coalesce("comp", "id").alias("comp"))
    classes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("low")).join(ids, "node")
    low = classes.groupBy("comp").agg(F.min("low").alias("component_id"))
    ids = materialize(classes.join(low, "comp").select("node", "component_id"), "jaccard_ids")
    return (rows.select("doc_id", F.col("n").alias("n_shingles"), "node").join(ids, "node", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def one_of_each(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """``docs``, all columns: of every component the row with the smallest id, once if repeated.

    Rows without an id stay where no row of their component has one, one for each text.
    """
    low = jaccard_components(docs, width, percent).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    low = materialize(low.groupBy(F.col("doc_id").alias("_low")).agg(F.count("*").alias("_rows")), "jaccard_low")

    def with_id_in(ids: DataFrame) -> DataFrame:
        return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("_low")), "left_semi")

    kept, repeated = with_id_in(low.filter("_rows = 1")), low.filter("_rows > 1")
    if repeated.isEmpty():
        return kept
    # whole texts are dealt out for repeated ids alone
    return kept.unionByName(with_id_in(repeated).dropDuplicates(["doc_id", "text"]))
