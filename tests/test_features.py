"""Categories, dense vocabulary ids, three-valued multi-hot, first occurrence."""

from tastebud.operators import features as FE


def _items(spark):
    return spark.createDataFrame(
        [("i1", 4.0, 3, 1, "b, a, b"), ("i2", 2.0, 1, 0, None), ("i3", 3.0, 2, 1, ""),
         ("i4", 5.0, 1, 1, "c")],
        "item_id string, stars double, review_count int, is_open int, categories string")


def test_vocab_dense_sorted(spark):
    v = FE.category_vocab(_items(spark)).orderBy("category_id").collect()
    assert [(r.category, r.category_id) for r in v] == [("a", 0), ("b", 1), ("c", 2)]


def test_dense_index_many_partitions(spark):
    df = spark.range(0, 5000).selectExpr("cast(id * 7 % 5000 as string) as k").repartition(13)
    got = FE.dense_index(df, "k", "ix").collect()
    order = sorted(r.k for r in got)
    assert {r.k: r.ix for r in got} == {k: i for i, k in enumerate(order)}


def test_multi_hot_three_values(spark):
    items = _items(spark)
    ids = FE.item_category_ids(items, FE.category_vocab(items))
    rows = spark.createDataFrame([("u", "i1"), ("u", "i2"), ("u", "i3"), ("u", "i9")],
                                 "user_id string, item_id string")
    got = {r.item_id: (r.n_categories, r.category_ids) for r in FE.multi_hot_rows(rows, ids).collect()}
    assert got == {"i1": (2, "0,1"), "i2": (None, None), "i3": (None, None), "i9": (None, None)}
    filled = {r.item_id: (r.n_categories, r.category_ids)
              for r in FE.multi_hot_rows(rows, ids, fill=True).collect()}
    assert filled["i2"] == (0, "") and filled["i1"] == (2, "0,1")


def test_first_occurrence_prefers_train(spark):
    rows = spark.createDataFrame([("u", "z", 1.0, "train"), ("u", "a", 2.0, "val"),
                                  ("u", "m", 3.0, "train")],
                                 "user_id string, item_id string, stars double, split string")
    r = FE.first_occurrence(rows, "user_id").first()
    assert (r.first_item_id, r.first_stars) == ("m", 3.0)
