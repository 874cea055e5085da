"""Routing expressions for cold-start cases and the hybrid blend."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prediction for an unknown user, and the hybrid blend weights
# (0.05 below 30 neighbours, else 0.15).
COLD_DEFAULT = 3.75
ALPHA_FEW = 0.05
ALPHA_FULL = 0.15
ALPHA_SUPPORT = 30

BOTH, USER_ONLY, ITEM_ONLY, NEITHER = "both", "user_only", "item_only", "neither"


def route(user_known: Column, item_known: Column) -> Column:
    """Which of the four cold-start cases a target falls in."""
    return (F.when(user_known & item_known, F.lit(BOTH))
            .when(user_known, F.lit(USER_ONLY))
            .when(item_known, F.lit(ITEM_ONLY))
            .otherwise(F.lit(NEITHER)))


def alpha(n_neighbours: Column) -> Column:
    return F.when(n_neighbours < ALPHA_SUPPORT, F.lit(ALPHA_FEW)).otherwise(F.lit(ALPHA_FULL))


def blend(a: Column, cf: Column, model: Column) -> Column:
    return a * cf + (F.lit(1.0) - a) * model
