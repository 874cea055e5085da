"""Column expressions of the item-item similarity rule.

All built-in functions, so they stay inside whole-stage codegen.  The
operation order of every formula is kept as specified because the thresholds
are hit exactly (e.g. ``1 - 2/5`` must compare equal to ``0.6``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the similarity rule (must equal the reference's for equal
# results): closeness scale 5; keep a neighbour only when the raw weight is
# above 0.8 (no co-raters), above 0.6 (one co-rater), above 0.7 (two), at
# least 0.1 (three or more, Pearson); amplification exponent 1.5; 30 neighbours.
CLOSENESS_SCALE = 5.0
KEEP_N0 = 0.8
KEEP_N1 = 0.6
KEEP_N2 = 0.7
KEEP_PEARSON = 0.1
AMPLIFY = 1.5
TOP_N = 30
# rank key precision: weights equal to 9 decimals tie and fall back to the id
RANK_DECIMALS = 9


def closeness(a: Column, b: Column) -> Column:
    """1 - |a - b| / 5."""
    return F.lit(1.0) - F.abs(a - b) / F.lit(CLOSENESS_SCALE)


def raw_weight(n: Column, m_i: Column, m_j: Column, s_close: Column,
               s_ij: Column, ss_i: Column, ss_j: Column) -> Column:
    """Raw similarity by co-rater count ``n``.

    n = 0        closeness of the two item means
    n = 1, 2     mean closeness of the co-ratings
    n >= 3       Pearson over co-raters centred on the all-ratings item means;
                 mean closeness when either centred norm is zero
    """
    mean_close = s_close / F.nullif(n.cast("double"), F.lit(0.0))
    pearson = s_ij / F.nullif(F.sqrt(ss_i) * F.sqrt(ss_j), F.lit(0.0))
    return (F.when(n == 0, closeness(m_i, m_j))
            .when(n <= 2, mean_close)
            .when((F.sqrt(ss_i) == 0) | (F.sqrt(ss_j) == 0), mean_close)
            .otherwise(pearson))


def keep(n: Column, raw: Column) -> Column:
    """True when the neighbour survives its branch threshold."""
    return (F.when(n == 0, raw > F.lit(KEEP_N0))
            .when(n == 1, raw > F.lit(KEEP_N1))
            .when(n == 2, raw > F.lit(KEEP_N2))
            .otherwise(raw >= F.lit(KEEP_PEARSON)))


def amplify(raw: Column) -> Column:
    """Case amplification w * |w|^1.5."""
    return raw * F.pow(F.abs(raw), F.lit(AMPLIFY))


def rank_key(raw: Column) -> Column:
    return F.round(raw, RANK_DECIMALS)
