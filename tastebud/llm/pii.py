"""Personal data: overlapping candidates, boosted trees, calibrated thresholds.

Native throughout: Spark SQL functions and Spark ML.

* Fixed rules find e-mail addresses, IP addresses, card and phone numbers.
  Their spans always stay.
* High-recall generators propose overlapping spans: anything like an address,
  also with the sign spelled out, and any run of digits with separators.
* Gradient-boosted trees score the candidates from format features (length,
  digits, groups, signs, checksum) and context features (words before, what
  stands at both ends).  They learn from the fixed rules: a candidate that is
  a rule's span is positive, one that no rule accepts is negative.  The fit
  reads four fifths of all candidates, by hash.
* A threshold is calibrated for each generator on the candidates kept out of the
  fit: the least score at which precision reaches ``precision``.  Candidates
  beyond it that overlap no fixed span are added, the best of overlapping ones.

A match's place is the sum of the lengths of the pieces and matches before it:
the text is split by the same pattern, so no position is searched twice, and the
sums of n matches take n * sqrt(n) additions.  The patterns are the rules' with
guards that change no match but keep long runs of digits or letters linear; the
generators have no upper bounds of length.

Offsets are code points, ends exclusive.  Null or empty text: no spans, the
digest of the empty string.  Repeated rows are searched apiece, a null id is
carried, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# The base kinds, in order, and their patterns.
MAIL_CHARS = "[A-Za-z0-9._%+-]"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": rf"(?:(?<!{MAIL_CHARS})|\G){MAIL_CHARS}+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: a cheap test that a text can hold a match
GATES = {"email": "@", "ip": ".", "card": "", "phone": "+"}
DIGIT = "[0-9]"
VALID = {
    "email": "true",
    "ip": "forall(split(x.m, '[.]'), p -> try_cast(p AS DOUBLE) <= 255)",
    "card": "length(translate(x.m, ' -', '')) BETWEEN 16 AND 19 AND luhn_check(translate(x.m, ' -', ''))",
    "phone": "length(regexp_replace(x.m, '[^0-9]', '')) BETWEEN 8 AND 15",
}
#: what can stand before an address' sign
NAME_CHARS = r"""[^\s@,;<>()"']"""
GENERATORS = {
    "address": rf"""(?:(?<!{NAME_CHARS})|\G){NAME_CHARS}++(?:@| ?[(\[]at[)\]] ?)[A-Za-z0-9-]++(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]++)++""",
    "number": r"[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+",
}
CONTEXT = 24
CANDIDATE = ("a", "z", "m", "before", "after")
BEFORE = {"tel": "tel|phone|call|fax|mobile", "mail": "mail|contact|write", "pay": "card|visa|credit|account|iban", "net": "ip|host|server|addr"}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def starts(lengths: Column) -> Column:
    """The sum of the lengths before each place, by blocks of sqrt(n): n * sqrt(n) additions, no array copied per place."""
    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda s, x: s + x)

    def by_block(of: Column, step: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(of) / step).cast("int")), lambda j: total(F.slice(of, j * step + 1, step)))
        before = let(blocks, lambda sums: F.transform(sums, lambda _, j: total(F.slice(sums, F.lit(1), j))))
        return let(before, lambda at: F.transform(of, lambda _, i: F.get(at, F.floor(i / step).cast("int"))
                                                  + total(F.slice(of, F.floor(i / step).cast("int") * step + 1, i % step))))

    return let(lengths, lambda of: let(F.greatest(F.ceil(F.sqrt(F.size(of))).cast("int"), F.lit(1)), lambda step: by_block(of, step)))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: array of (a, z, m), start and end in code points."""
    found, parts = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pair = F.zip_with(found, F.slice(parts, 1, F.greatest(F.size(found), F.lit(1))), lambda m, p: F.struct(m.alias("m"), F.length(p).alias("gap")))
    pair = F.filter(pair, lambda x: x["m"].isNotNull())

    def placed(pairs: Column) -> Column:
        before = starts(F.transform(pairs, lambda x: x["gap"] + F.length(x["m"])))
        return F.zip_with(pairs, before, lambda x, at: F.struct(
            (at + x["gap"]).alias("a"), (at + x["gap"] + F.length(x["m"])).alias("z"), x["m"].alias("m")))

    return let(pair, placed)


NO_SPANS = "CAST(array() AS ARRAY<STRUCT<a: INT, z: INT, m: STRING>>)"


def with_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row, one array of spans (a, z, m) for each base kind, and one of candidates for each generator."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("digits", F.col("text").rlike(DIGIT))
    for kind in KINDS:
        gate = F.contains("text", F.lit(GATES[kind]))
        gate = gate if kind == "email" else gate & F.col("digits")
        rows = rows.withColumn(f"all_{kind}", F.when(gate, matches(F.col("text"), PATTERNS[kind])).otherwise(F.expr(NO_SPANS)))
        rows = rows.withColumn(kind, F.expr(f"filter(all_{kind}, x -> {VALID[kind]})")).drop(f"all_{kind}")
    signed = F.contains("text", F.lit("@")) | F.contains("text", F.lit("(at)")) | F.contains("text", F.lit("[at]"))
    for name, gate in (("address", signed), ("number", F.col("digits"))):
        got = F.when(gate, matches(F.col("text"), GENERATORS[name])).otherwise(F.expr(NO_SPANS))
        rows = rows.withColumn(name, F.transform(got, lambda x: F.struct(
            x["a"].alias("a"), x["z"].alias("z"), x["m"].alias("m"),
            F.substr("text", F.greatest(x["a"] - CONTEXT + 1, F.lit(1)), F.least(x["a"], F.lit(CONTEXT))).alias("before"),
            F.substr("text", x["z"] + 1, F.lit(4)).alias("after"))))
    return rows.drop("text", "digits")


def featured(spans: DataFrame) -> tuple[DataFrame, list[str]]:
    """Candidates, one a row: row, generator, a, z, label and the features' names."""
    base = F.concat(*(F.transform(kind, lambda x: F.struct("row", x["a"].alias("a"), x["z"].alias("z"))) for kind in KINDS))
    typed = F.concat(*(F.transform(F.col(g), lambda x: F.struct(F.lit(g).alias("generator"), *(x[c].alias(c) for c in CANDIDATE))) for g in GENERATORS))
    rows = spans.select("row", base.alias("base"), F.explode(typed).alias("c")).select("row", "base", "c.*")
    rows = rows.withColumn("label", F.exists("base", lambda b: (b["a"] == F.col("a")) & (b["z"] == F.col("z"))).cast("double"))
    rows = rows.withColumn("overlaps", F.exists("base", lambda b: (b["a"] < F.col("z")) & (b["z"] > F.col("a"))))
    digits, low = F.regexp_replace("m", "[^0-9]", ""), F.lower("before")
    groups = F.filter(F.split("m", "[^0-9]+"), lambda g: g != "")
    value = {
        "length": F.length("m"), "digits": F.length(digits), "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "shortest_group": F.coalesce(F.array_min(F.transform(groups, lambda g: F.length(g))), F.lit(0)),
        "dots": F.length("m") - F.length(F.translate("m", ".", "")), "dashes": F.length("m") - F.length(F.translate("m", "-", "")),
        "spaces": F.length("m") - F.length(F.translate("m", " ", "")), "letters": F.length(F.regexp_replace("m", "[^A-Za-z]", "")),
        "plus": F.startswith("m", F.lit("+")), "bracket": F.contains("m", F.lit("(")), "at": F.contains("m", F.lit("@")),
        "checksum": F.when(F.length(digits).between(12, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False)),
        "octets": F.forall(groups, lambda g: F.length(g) <= 3), "date": F.col("m").rlike(r"^(19|20)[0-9]{2}[./-]"),
        "glued_left": F.col("before").rlike(r"[A-Za-z0-9_=/]$"), "glued_right": F.col("after").rlike(r"^[A-Za-z0-9_=/]"),
        **{f"near_{k}": low.rlike(rf"\b(?:{v})\b") for k, v in BEFORE.items()},
        "address": F.col("generator") == "address",
    }
    rows = rows.withColumns({f"f_{k}": F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in value.items()})
    return rows.drop("base", "before", "after"), [f"f_{k}" for k in value]


def boosted(rows: DataFrame, names: list[str], precision: float) -> tuple[object, dict[str, float]] | None:
    """Trees and a threshold for each generator, learned from all of ``rows``, or None where they have one class only."""
    fold = F.pmod(F.xxhash64("row", "a", "z", "m"), F.lit(5)).alias("fold")
    known = rows.select("generator", "label", fold, *names)
    known = materialize(VectorAssembler(inputCols=names, outputCol="features").transform(known).select("generator", "label", "fold", "features"), "pii_candidates")
    classes = known.groupBy("fold", "label").count().collect()
    if len({r["label"] for r in classes if r["fold"]}) < 2:
        return None
    trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=3, cacheNodeIds=False).fit(known.filter("fold > 0"))
    kept = trees.transform(known.filter("fold = 0")).withColumn("bin", F.floor(vector_to_array("probability")[1] * 50))
    bins = kept.groupBy("generator", "bin").agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    limits = {}
    for g in GENERATORS:
        own = sorted((r["bin"], r["good"], r["n"]) for r in bins if r["generator"] == g)
        able = [b for b, _, _ in own if sum(x[1] for x in own if x[0] >= b) >= precision * sum(x[2] for x in own if x[0] >= b)]
        limits[g] = min(able) / 50 if able else 2.0
    return trees, limits


def personal_data(docs: DataFrame, precision: float = 0.95) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added for every row of ``docs``."""
    spans = materialize(with_spans(docs), "pii_spans")
    rows, names = featured(spans)
    model = boosted(rows, names, precision)
    if model is None:
        added = None
    else:
        trees, limits = model
        open_ = VectorAssembler(inputCols=names, outputCol="features").transform(rows.filter(~F.col("overlaps")))
        scored = trees.transform(open_).withColumn("score", vector_to_array("probability")[1])
        least = F.when(F.col("generator") == "address", limits["address"]).otherwise(limits["number"])
        kept = scored.filter(F.col("score") >= least)
        # of overlapping additions the best stays; generators give at most two that overlap at a place
        other = kept.select(F.col("row").alias("r"), F.col("a").alias("oa"), F.col("z").alias("oz"), F.col("score").alias("os"))
        worse = (F.col("row") == F.col("r")) & (F.col("oa") < F.col("z")) & (F.col("oz") > F.col("a")) & (
            (F.col("os") > F.col("score")) | ((F.col("os") == F.col("score")) & ((F.col("oa") < F.col("a")) | ((F.col("oa") == F.col("a")) & (F.col("oz") > F.col("z"))))))
        added = (kept.join(other, worse, "left_anti").groupBy("row")
                 .agg(F.array_sort(F.collect_list(F.struct("a", "z"))).alias("added")))
    spans = spans.withColumn("added", F.lit(None).cast("array<struct<a:int,z:int>>")) if added is None else spans.join(added, "row", "left")
    text = lambda kind, c: F.transform(c, lambda x: F.concat_ws(":", F.lit(kind), x["a"], x["z"]))
    more = F.coalesce("added", F.expr("CAST(array() AS ARRAY<STRUCT<a: INT, z: INT>>)"))
    base = F.concat(*(text(kind, F.col(kind)) for kind in KINDS))
    return spans.select(
        "doc_id", *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, text("gbt", more)), ",").alias("spans"), F.size(more).cast("long").alias("n_added"))
