"""Quality rules: a ledger of measurements and failure bits, then policies as masks.

Native throughout.  Every rule is evaluated once per document; the ledger keeps
its measurements and one bit for each failed rule.  A policy is a version, i.e.
a mask of rules; a document passes where its bits and the mask share none.
Ablations need the ledger only: documents are counted by bit pattern, and a
grouped sum over the few patterns says what each rule of a policy rejects, and
what it alone rejects.

Words are runs outside ``\\x20 \\x09-\\x0D``.  Null or empty text: no words, all
measurements 0.  A null id is carried, repeated rows are judged apiece, extra
columns are ignored.  Texts of any length take time in proportion to
length * log(length) and memory in proportion to length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
WINDOW = 5

#: (rule, SQL over the measurements): a rule's place is its bit, so rules are only ever appended.
RULES: tuple[tuple[str, str], ...] = (
    ("too_short", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("word_length", "n_words > 0 and (word_chars < 2 * n_words or word_chars > 14 * n_words)"),
    ("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
    ("shouting", "2 * n_upper > word_chars"),
    ("exclamations", "5 * n_exclaims > n_words"),
)
#: policies by version: names of rules
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_short", "repeated_windows"),
    "v1": ("too_short", "repeated_windows", "symbols", "repeated_lines"),
    "v2": tuple(name for name, _ in RULES),
}


def without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


#: words in windows of WINDOW words that occur twice or more, from an array of window hashes ``h``
REPEATED = f"""
CASE WHEN size(array_distinct(h)) = size(h) THEN 0L ELSE
  aggregate(
    transform(array(sort_array(transform(
        filter(transform(array(sort_array(transform(h, (x, i) -> struct(x AS x, i AS i)))),
               s -> transform(s, (e, k) -> IF(get(s, k - 1).x <=> e.x OR get(s, k + 1).x <=> e.x, e.i, -1)))[0],
               i -> i >= 0), i -> i))),
      p -> transform(p, (i, k) -> CAST(least({WINDOW}, coalesce(get(p, k + 1) - i, {WINDOW})) AS BIGINT)))[0],
    0L, (a, b) -> a + b)
END"""


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to doc_id and the measurements."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("w", words(F.col("text")))
    windows = F.expr(f"""CASE WHEN size(w) < {WINDOW} THEN CAST(array() AS ARRAY<BIGINT>)
        ELSE transform(sequence(0, size(w) - {WINDOW}), i -> xxhash64({', '.join(f'w[i + {k}]' for k in range(WINDOW))})) END""")
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(without(x, SPACE)) > 0)
    rows = rows.select("doc_id", "text", F.size("w").cast("long").alias("n_words"), windows.alias("h"), lines.alias("lines"))
    dense = without(F.col("text"), SPACE)
    return rows.select(
        "doc_id", "n_words", F.length(dense).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(REPEATED).cast("long").alias("n_repeat_words"),
        (F.length("text") - F.length(without(F.col("text"), UPPER))).cast("long").alias("n_upper"),
        (F.length("text") - F.length(without(F.col("text"), "!"))).cast("long").alias("n_exclaims"))


def bit(name: str) -> int:
    return next(i for i, (rule, _) in enumerate(RULES) if rule == name)


def mask(policy: str) -> int:
    return sum(1 << bit(name) for name in POLICIES[policy])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements and ``fail_bits``: a row a document, every rule evaluated once."""
    failed = " | ".join(f"IF({sql}, {1 << i}L, 0L)" for i, (_, sql) in enumerate(RULES))
    return measured(docs).withColumn("fail_bits", F.expr(failed))


def passes(fail_bits: Column, policy: str) -> Column:
    return fail_bits.bitwiseAND(F.lit(mask(policy))) == 0


def ablation(rows: DataFrame, policy: str) -> DataFrame:
    """rule, rejected, rejected_alone: for each rule of a policy, over a ledger."""
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).count()
    one = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.lit(1 << bit(name)).cast("long").alias("b")) for name in POLICIES[policy])))
    return (patterns.select("bits", "count", one.alias("r")).filter(F.col("bits").bitwiseAND(F.col("r.b")) != 0)
            .groupBy("r.rule").agg(F.sum("count").alias("rejected"),
                                   F.sum(F.when(F.col("bits") == F.col("r.b"), F.col("count")).otherwise(0)).alias("rejected_alone")))
