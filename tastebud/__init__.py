"""tastebud: star-rating prediction as Spark DataFrame plans.

Sub-packages
------------
sources    schemas, readers, fixture views over the driver tables, sinks
functions  column expressions (similarity rules, routes, error buckets)
operators  DataFrame -> DataFrame building blocks (ratings, similarity, CF,
           features, embedding, boosted trees, tuning, hybrid, evaluation)
plans      the registry of named queries and their DuckDB oracle SQL
streaming  micro-batch scoring of target pairs with the batch operators
"""

__all__ = ["session"]
