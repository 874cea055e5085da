"""URL filter: a blocked Bloom filter of listed keys, then an exact hash join.

Native throughout.  A listed key is a host suffix and a path prefix, as in
``example.org/es/``.  A URL's candidate keys are its host suffixes (as many
labels as listed hosts have) with its path prefixes (of the lengths that listed
paths have).  The Bloom filter is an array of 64-bit blocks, ``HASHES`` bits of
one block a key, so one candidate reads one word; it is built by a grouped
bitwise OR and sized by the list.  Up to ``LARGEST_BLOCKS`` blocks (counted
first) it is one value that every task reads; a filter of a longer list stays a
table of blocks, dealt by block number, that the candidates are joined to.  Only
candidates that pass it reach the join with the list, which removes false
positives; a URL's longest key decides.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased; the path runs on to ``?``, ``#`` or the end.  Null or without
``://``: both empty, no rule, the default verdict.  Of keys listed twice, block
wins.  Repeated rows are judged apiece, extra columns are ignored.  An empty
table gives no rows, an empty list the default verdict for all.  A URL has at most
(listed labels) x (listed path lengths) candidates, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_az, materialize

HASHES = 4
BITS_PER_KEY = 16
LARGEST_BLOCKS = 1 << 20        # 8 MB, of a list of four million keys


def host(url: Column) -> Column:
    return lower_az(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def pattern_of(key: Column) -> Column:
    """HASHES bits of one word, from a second hash of the key."""
    h = F.xxhash64(key, F.lit(1))
    out = F.lit(0).cast("long")
    for k in range(HASHES):
        place = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return out


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(b, p): the filter of ``keys`` (key), its blocks that have a bit."""
    return (keys.select(block_of(F.col("key"), blocks).alias("b"), pattern_of(F.col("key")).alias("p"))
            .groupBy("b").agg(F.bit_or("p").alias("p")))


def bloom(keys: DataFrame, blocks: int) -> DataFrame:
    """One row, one column ``words``: the filter of ``keys`` (key), an array of ``blocks`` words."""
    full = keys.sparkSession.range(blocks).select(F.col("id").alias("b")).join(bloom_blocks(keys, blocks), "b", "left")
    rows = F.array_sort(F.collect_list(F.struct("b", F.coalesce("p", F.lit(0).cast("long")).alias("p"))))
    return full.agg(rows["p"].alias("words"))


def judged(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages`` (page_id, url).

    ``listed`` has host, path, verdict.  ``rule`` is the deciding key or null.
    """
    listed = (listed.select(F.concat("host", "path").alias("key"), "host", "path", "verdict")
              .groupBy("key").agg(F.max("verdict").alias("verdict"), F.max(F.size(F.split("host", "[.]"))).alias("labels"),
                                  F.max(F.length("path")).alias("prefix")))
    facts = listed.agg(F.count("*").alias("n"), F.max("labels").alias("labels"), F.sort_array(F.collect_set("prefix")).alias("prefixes")).first()
    blocks = max(1, facts["n"] * BITS_PER_KEY // 64 + 1)

    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    if not facts["n"]:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(facts["labels"]))),
                           lambda n: F.array_join(F.slice(labels, -n, n), "."))
    prefixes = F.transform(F.filter(F.array(*(F.lit(n) for n in facts["prefixes"])), lambda n: n <= F.length("path")),
                           lambda n: F.substr(F.col("path"), F.lit(1), n))
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    # written, as both branches below read the numbers
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "url_rows")
    keyed = rows.filter("host <> ''")
    if blocks <= LARGEST_BLOCKS:
        def passes(key: Column) -> Column:
            word = F.get(F.col("words"), block_of(key, blocks).cast("int"))
            return word.bitwiseAND(pattern_of(key)) == pattern_of(key)

        keyed = keyed.withColumn("words", bloom(listed, blocks).scalar())
        hits = keyed.select("row", F.explode(F.filter(keys, passes)).alias("key"))
    else:
        hits = (keyed.select("row", F.explode(keys).alias("key")).withColumn("b", block_of(F.col("key"), blocks))
                .join(bloom_blocks(listed, blocks), "b").filter(F.col("p").bitwiseAND(pattern_of(F.col("key"))) == pattern_of(F.col("key"))))
    hits = (hits.select("row", "key").join(listed.select("key", "verdict"), "key")
            .groupBy("row").agg(F.max_by(F.struct(F.col("key").alias("rule"), "verdict"), F.length("key")).alias("x")))
    return (rows.join(hits, "row", "left")
            .select("page_id", "host", "path", F.col("x.rule").alias("rule"), F.coalesce("x.verdict", F.lit(default)).alias("verdict")))
