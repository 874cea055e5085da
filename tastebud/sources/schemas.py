"""Fixed schemas of the inputs (ratings, targets, profiles) and outputs."""

from pyspark.sql import types as T

# Labelled rating file: user, item, stars (header line in CSV form).
RATING = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("item_id", T.StringType(), True),
    T.StructField("stars", T.DoubleType(), True),
])

# Target pairs: the first two columns; any further columns are ignored.
TARGET = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("item_id", T.StringType(), True),
])

# Item profile (JSON lines).  The source names the id ``business_id``; readers
# rename it to ``item_id``.
ITEM_JSON = T.StructType([
    T.StructField("business_id", T.StringType(), True),
    T.StructField("stars", T.DoubleType(), True),
    T.StructField("review_count", T.IntegerType(), True),
    T.StructField("is_open", T.IntegerType(), True),
    T.StructField("categories", T.StringType(), True),
])

# User profile (JSON lines).
USER_JSON = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("review_count", T.IntegerType(), True),
    T.StructField("average_stars", T.DoubleType(), True),
    T.StructField("useful", T.IntegerType(), True),
    T.StructField("funny", T.IntegerType(), True),
    T.StructField("cool", T.IntegerType(), True),
    T.StructField("fans", T.IntegerType(), True),
])

USER_FEATURES = ["review_count", "average_stars", "useful", "funny", "cool", "fans"]
# item feature names after the join; ``stars`` is renamed so it cannot clash
# with the rating label
ITEM_FEATURES = ["item_stars", "item_review_count", "is_open"]
BASE_FEATURES = USER_FEATURES + ITEM_FEATURES
EMBED_DIM = 16
