"""Scale paths of the selection helpers, forced on small data and checked by brute force."""

from pyspark.sql import functions as F

from spendlens.functions import keys as K
from spendlens.operators import features as FE


def test_kth_smallest_refines_large_buckets(spark, monkeypatch):
    # force the multi-level prefix refinement that only triggers on huge buckets
    monkeypatch.setattr(K, "_FINAL_BUCKET_ROWS", 3)
    monkeypatch.setattr(K, "_PREFIX_STEP", 1)
    df = spark.range(3000).withColumn("g", (F.col("id") % 3).cast("int")).withColumn(
        "h", K.order_key(42, "id"))
    ks = {0: 7, 1: 500, 2: 1000}
    cuts = K.kth_smallest(df, "h", ks, by="g")
    for g, k in ks.items():
        hs = sorted(r["h"] for r in df.where(F.col("g") == g).collect())
        assert cuts[g] == hs[k - 1]


def test_dense_index_matches_sort(spark):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("x")).repartition(5)
    got = {r["x"]: r["i"] for r in K.dense_index(df, ["x"], "i").collect()}
    assert got == {x: x for x in range(2000)}


def test_exact_quantiles(spark):
    vals = [float(v) for v in [5, 1, 9, 3, 3, 8, 2, 7, 6, 4, 10, 0]]
    vals += [3.0] * 9  # one value holds over 40 % of the rows
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    got = FE.exact_quantiles(df, "x", [0.0, 0.25, 0.5, 0.9, 1.0])
    s = sorted(vals)

    def pct(q):
        pos = q * (len(s) - 1)
        lo = int(pos)
        hi = min(lo + 1, len(s) - 1)
        return s[lo] + (s[hi] - s[lo]) * (pos - lo)

    assert [round(x, 9) for x in got] == [round(pct(q), 9) for q in [0.0, 0.25, 0.5, 0.9, 1.0]]


def test_quantiles_of_nothing_and_of_one_value(spark):
    none = spark.createDataFrame([], "x double")
    assert FE.exact_quantiles(none, "x") == []
    assert FE.exact_quantiles(spark.createDataFrame([(2.0,)] * 5, "x double"), "x", [0.0, 0.3, 1.0]) == [2.0] * 3


def test_vendor_index_with_a_hot_vendor(spark):
    rows = [("hot",)] * 400 + [(f"v{i:03d}",) for i in range(600)]
    got = {r[0]: r[1] for r in FE.vendor_index(spark.createDataFrame(rows, "vendor_id string")).collect()}
    assert got == {v: i for i, v in enumerate(sorted({r[0] for r in rows}))}
