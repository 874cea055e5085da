"""Mixing sources to target weights by hash thresholds.

Every row has a 60-bit hash of its id and text.  The words of each source are
summed by the hash's first 12 bits; the bucket in which a source's budget runs
out is summed again by the next 12 bits, and so on until that bucket holds one
row.  What is below the threshold is taken, in a filter: no sort, no shuffle of
texts, and the same rows in every run.  A larger budget has larger thresholds,
so budgets are nested: the rows of a smaller one are among those of a larger.

A target of more than the source has takes every row ``floor(target / size)``
times and the remainder by threshold; the last row is taken where that is
nearer to the target.  Targets share a budget by weight, none above
``most`` times its source's size, the excess going to the others by weight.

Histograms are per source and bucket, sums before the shuffle, so a hot source
costs what any other costs.  Sources and their weights are a configuration:
one row a source reaches the driver.

Null text counts no words.  A null source is a source, the last one.  Rows
equal in id and text share one hash and are taken or left together.  Result
columns replace columns of the same name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialize

BITS, LEVELS = 12, 5
FEW_SOURCES = 100_000   # rows of a configuration that is broadcast; a larger one meets the texts in a shuffled join


def small(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A configuration table, broadcast where its rows are counted to be few."""
    df = spark.createDataFrame(rows, schema)
    return F.broadcast(df) if len(rows) <= FEW_SOURCES else df


def cyclic_weights(sources: Sequence[str | None], cycle: Sequence[float] = (1, 2, 3)) -> dict[str | None, float]:
    """Weights in turn to the sources by code point, null last."""
    order = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[i % len(cycle)] for i, s in enumerate(order)}


def targets(sizes: dict[str | None, int], weights: dict[str | None, float], budget: float, most: float = 3.0) -> dict[str | None, float]:
    """Each source's share of ``budget`` by weight, at most ``most`` times its size."""
    open_, fixed = {s for s, n in sizes.items() if n > 0 and weights.get(s, 0) > 0}, {}
    while open_:
        rest, total = budget - sum(fixed.values()), sum(weights[s] for s in open_)
        above = {s for s in open_ if rest * weights[s] / total > most * sizes[s]}
        if not above:
            return {s: 0.0 for s in sizes} | fixed | {s: rest * weights[s] / total for s in open_}
        fixed |= {s: most * sizes[s] for s in above}
        open_ -= above
    return {s: 0.0 for s in sizes} | fixed


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash60(doc_id: Column, text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 64 - BITS * LEVELS)


def thresholds(rows: DataFrame, budgets: list[tuple[int, str | None, float]]) -> list[tuple[int, str | None, int]]:
    """(budget, source, threshold): rows (source, u, size) below it sum to about the budget's words.

    ``budgets`` has (budget number, source, words), words below the source's size.
    """
    spark = rows.sparkSession
    state = [(k, s, 0, float(words)) for k, s, words in budgets]
    schema = "k int, source string, cell long, words double"
    done: list[tuple[int, str | None, int]] = []
    for level in range(1, LEVELS + 1):
        if not state:
            break
        up, here = BITS * (LEVELS - level + 1), BITS * (LEVELS - level)
        now = small(spark, state, schema)
        cells = (rows.withColumn("cell", F.shiftright("u", up)).join(
            now.withColumnsRenamed({"source": "s", "cell": "c"}), F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
            .groupBy("k", "source", F.shiftright("u", here).alias("cell"))
            .agg(F.sum("size").alias("n"), F.count("*").alias("rows"), F.max("words").alias("words")))
        # at most 2**BITS rows for each budget and source: the first cell that goes beyond the words left
        before = F.expr("sum(n) over (partition by k, source order by cell) - n")
        first = (cells.withColumn("before", before).filter("before + n > words").groupBy("k", "source")
                 .agg(F.min_by(F.struct("cell", "n", "rows", "before", "words"), "cell").alias("x"))
                 .select("k", "source", "x.*").collect())
        state = []
        for r in first:
            if r["rows"] > 1 and here:
                state.append((r["k"], r["source"], r["cell"], r["words"] - r["before"]))
            else:
                nearer = r["before"] + r["n"] - r["words"] < r["words"] - r["before"]
                done.append((r["k"], r["source"], (r["cell"] + nearer) << here))
    return done


def mixed(docs: DataFrame, shares: Sequence[float] = (1.0,), weights: dict[str | None, float] | None = None,
          most: float = 3.0) -> DataFrame:
    """``docs`` with size, source_size, target, copies (times taken) and taken (words); target_k, copies_k, taken_k for each further share.

    A share is a budget: that part of all words of ``docs``.  ``weights`` are
    ``cyclic_weights`` unless given.
    """
    spark = docs.sparkSession
    docs = docs.withColumns({"size": word_count(F.col("text")), "_u": hash60(F.col("doc_id"), F.col("text"))})
    rows = materialize(docs.select(F.col("source").cast("string"), F.col("_u").alias("u"), "size"), "mix_rows")
    sizes = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    weights = cyclic_weights(list(sizes)) if weights is None else weights
    goal = [targets(sizes, weights, share * sum(sizes.values()), most) for share in shares]
    left = [(k, s, t[s] - sizes[s] * int(t[s] // sizes[s])) for k, t in enumerate(goal) for s in sizes if sizes[s]]
    below = {(k, s): u for k, s, u in thresholds(rows, [x for x in left if x[2] > 0])}
    plan = [(s, sizes[s], [t[s] for t in goal], [int(t[s] // sizes[s]) if sizes[s] else 0 for t in goal],
             [below.get((k, s), 0) for k in range(len(goal))]) for s in sizes]
    plan = small(spark, plan, "_s string, _n long, _target array<double>, _copies array<int>, _below array<long>")
    out = docs.join(plan, F.col("source").cast("string").eqNullSafe(F.col("_s")), "left")
    new = {"source_size": F.col("_n")}
    for k in range(len(goal)):
        tail = f"_{k}" if k else ""
        new["target" + tail] = F.col("_target")[k]
        new["copies" + tail] = F.col("_copies")[k] + F.when(F.col("_u") < F.col("_below")[k], 1).otherwise(0)
        new["taken" + tail] = F.col("size") * new["copies" + tail]
    return out.withColumns(new).drop("_u", "_s", "_n", "_target", "_copies", "_below")
