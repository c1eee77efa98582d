import math
import random
from collections import Counter

from pyspark.sql import functions as F

from spendlens.functions.keys import kth_smallest, kth_smallest_many, order_key
from spendlens.operators import split as S
from spendlens.plans.catalog import expenses

from conftest import SF_MEDIUM, SF_SMALL


def test_kth_smallest_matches_sort(spark):
    df = spark.range(5000).withColumn("h", order_key(7, "id"))
    hs = sorted(r["h"] for r in df.collect())
    cuts = kth_smallest(df, "h", {None: 1234})
    assert cuts[None] == hs[1233]
    assert df.where(F.col("h") <= cuts[None]).count() == 1234


def test_random_split_size(spark):
    s = S.random_split(expenses(spark, SF_SMALL))
    assert s.where("split = 'test'").count() == math.ceil(0.2 * 200)


def test_group_split_keeps_groups_whole(spark):
    s = S.group_split(expenses(spark, SF_MEDIUM))
    mixed = s.groupBy("item_key").agg(F.count_distinct("split").alias("n")).where("n > 1")
    assert mixed.count() == 0
    assert s.select("item_key").distinct().where(F.lit(True)).count() > 0


def test_balanced_split_invariants(spark):
    s = S.balanced_unseen_split(expenses(spark, SF_MEDIUM)).cache()
    test = s.where("split = 'test'")
    per_label = test.groupBy("account_name").count().collect()
    assert per_label and all(r["count"] == 3 for r in per_label)
    pairs = ["account_name", "item_key"]
    shared = test.select(*pairs).intersect(s.where("split = 'train'").select(*pairs))
    assert shared.count() == 0
    # ineligible labels stay in train in full
    counts = expenses(spark, SF_MEDIUM).groupBy("account_name").count()
    small = counts.where("count - 3 < 5").select("account_name")
    assert s.join(small, "account_name").where("split != 'train'").count() == 0


def test_oversample_reaches_min_count_and_spares_large_labels(spark):
    df = expenses(spark, SF_SMALL)
    out = S.oversample_minority(df, min_count=10)
    before = {r[0]: r[1] for r in df.groupBy("account_name").count().collect()}
    after = {r[0]: r[1] for r in out.groupBy("account_name").count().collect()}
    for label, n in before.items():
        assert after[label] == max(n, 10)
    # copies repeat existing rows of the same label
    copies = out.where("copy_no > 0").select("row_id", "account_name")
    assert copies.join(df.select("row_id", "account_name"), ["row_id", "account_name"], "left_anti").count() == 0


def test_stratified_folds_keep_groups(spark):
    f = S.stratified_group_folds(expenses(spark, SF_MEDIUM))
    assert f.groupBy("item_key").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    assert {r[0] for r in f.select("fold").distinct().collect()} == {0, 1, 2}


def test_stratified_folds_share_every_label(spark):
    """Groups of one to many labels, a hot group and a hot label: the stated bounds hold."""
    rng = random.Random(5)
    rows = [(f"g{g}", f"l{rng.choice((0, 0, 0, 1, 2, 3))}") for g in range(400) for _ in range(rng.randint(1, 6))]
    rows += [("hot", "l0")] * 500 + [("alone", "rare")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_id long, item_key string, account_name string")
    folds = {}
    for r in S.stratified_group_folds(df, 4).collect():
        folds.setdefault(r.item_key, set()).add(r.fold)
    assert all(len(x) == 1 for x in folds.values()) and len(folds) == 402
    sizes, by_vector, own = Counter(), {}, {}
    for g, (fold,) in folds.items():
        vector = Counter(label for h, label in rows if h == g)
        dom = min(vector, key=lambda x: (-vector[x], x))
        sizes[fold] += 1
        by_vector.setdefault(tuple(sorted(vector.items())), Counter())[fold] += 1
        own.setdefault(dom, []).append((fold, vector[dom]))
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for dom, members in own.items():
        share = [sum(n for f, n in members if f == fold) for fold in range(4)]
        assert max(share) - min(share) <= max(n for _, n in members)
    for counts in by_vector.values():
        assert max(counts[f] for f in range(4)) - min(counts[f] for f in range(4)) <= 1
    assert S.stratified_group_folds(df.limit(0)).count() == 0


def test_repeated_split_ids(spark):
    s = S.repeated_split(expenses(spark, SF_SMALL), n_splits=3)
    assert s.select("split_id").distinct().count() == 3
    assert s.count() == 3 * 200


def test_many_ranks_at_once(spark):
    rows = [(g, f"{i:05d}") for g, n in (("a", 700), ("b", 3), (None, 50)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i string").withColumn("h", order_key(3, "g", "i")).cache()
    ks = {"a": [1, 350, 700, 701, 0], "b": [2], None: [50]}
    own = {g: sorted(r["h"] for r in df.collect() if r["g"] == g) for g in ks}
    got = kth_smallest_many(df, "h", ks, by="g")
    assert got == {("a", 1): own["a"][0], ("a", 350): own["a"][349], ("a", 700): own["a"][699], ("a", 701): "g" * 32,
                   ("b", 2): own["b"][1], (None, 50): own[None][49]}


def test_many_ranks_refine_large_buckets(spark, monkeypatch):
    from spendlens.functions import keys
    monkeypatch.setattr(keys, "_FINAL_BUCKET_ROWS", 2)
    monkeypatch.setattr(keys, "_PREFIX_STEP", 1)
    df = spark.range(400).withColumn("h", order_key(1, "id")).cache()
    hs = sorted(r["h"] for r in df.collect())
    got = keys.kth_smallest_many(df, "h", {None: [1, 77, 78, 400]})
    assert [got[None, k] for k in (1, 77, 78, 400)] == [hs[0], hs[76], hs[77], hs[399]]


def test_repeated_balanced_split_is_the_single_split_of_each_seed(spark):
    df = expenses(spark, SF_SMALL).drop("text")
    many = S.balanced_repeated_split(df, repeats=3, strict=True)
    for r in range(3):
        one = S.balanced_unseen_split(df, seed=42 + r, strict=True).select("row_id", "split")
        own = many.where(F.col("repeat") == r).select("row_id", "split")
        assert one.exceptAll(own).isEmpty() and own.exceptAll(one).isEmpty()
