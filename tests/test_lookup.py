from spendlens.operators import lookup as LK


def test_majority_ties_pick_smallest_label(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", "b"), ("k", "a"), ("j", "z")],
                               "item_key string, account_name string")
    got = {r["item_key"]: r["item_label"] for r in LK.majority_by(df, "item_key", out="item_label").collect()}
    assert got == {"k": "a", "j": "z"}
    assert LK.global_majority(df) == "a"


def test_lookup_chain_and_unknown_vendor(spark):
    train = spark.createDataFrame([("i1", "v1", "A"), ("i2", "v1", "B"), ("i3", "v1", "B"),
                                   ("i4", "v2", "C")], "item_key string, vendor_id string, account_name string")
    test = spark.createDataFrame([("i1", "v9", "A"), ("new", "v1", "B"), ("new", "v9", "B")],
                                 "item_key string, vendor_id string, account_name string")
    got = [r["predicted"] for r in LK.lookup_predict(train, test).orderBy("item_key", "vendor_id").collect()]
    assert got == ["A", "B", "B"]


def test_vendor_fallback_threshold(spark):
    pred = spark.createDataFrame(
        [(1, "v1", "M", 0.5), (2, "v1", "M", 0.49), (3, "v9", "M", 0.1), (4, "v2", "M", 0.1)],
        "row_id int, vendor_id string, predicted string, max_prob double")
    vmap = spark.createDataFrame([("v1", "V"), ("v2", "")], "vendor_id string, vendor_label string")
    out = {r["row_id"]: (r["predicted"], r["source"])
           for r in LK.apply_vendor_fallback(pred, vmap, 0.5).collect()}
    assert out == {1: ("M", "model"), 2: ("V", "vendor_fallback"), 3: ("M", "model"), 4: ("M", "model")}
