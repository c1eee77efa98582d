"""Sketches merged from any split of the rows stay within their bounds of the exact numbers."""

import random

from pyspark.sql import functions as F

from spendlens.operators import sketches as SK

SCHEMA = "account_name string, item_key string, amount_log double"


def _rows():
    rng = random.Random(3)
    rows = [("hot", f"i{rng.randrange(9000)}", rng.gauss(5, 2)) for _ in range(20_000)]
    rows += [(f"l{rng.randrange(30)}", f"i{rng.randrange(400)}", rng.expovariate(1)) for _ in range(10_000)]
    return rows + [("hot", "i1", 4.0)] * 5_000


def test_merged_parts_keep_the_bounds(spark):
    rows = _rows()
    whole = spark.createDataFrame(rows, SCHEMA)
    parts = [SK.label_sketches(spark.createDataFrame(rows[i::3], SCHEMA)) for i in range(3)]
    by_label = SK.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]), "account_name")
    exact = {r["account_name"]: (r["n"], r["d"]) for r in whole.groupBy("account_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("item_key").alias("d")).collect()}
    got = SK.estimates(by_label, [0.5]).collect()
    assert {r["account_name"] for r in got} == set(exact)
    for r in got:
        n, d = exact[r["account_name"]]
        assert r["rows"] == n and abs(r["unique_items"] - d) <= max(1, 4 * SK.DISTINCT_ERROR * d)
    fractions = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    one = SK.estimates(SK.merged(by_label), fractions).first()
    amounts = sorted(r[2] for r in rows)
    for f, q in zip(fractions, one["quantiles"], strict=True):
        below, upto = sum(x < q for x in amounts), sum(x <= q for x in amounts)
        assert below <= (f + 2 * SK.RANK_ERROR) * len(rows) and upto >= (f - 2 * SK.RANK_ERROR) * len(rows)


def test_nulls_ties_and_empty_tables(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 1.0), ("b", None, None), (None, "z", 3.0)], SCHEMA)
    got = {r["account_name"]: tuple(r)[1:] for r in SK.estimates(SK.label_sketches(df), [0.0, 1.0]).collect()}
    assert got == {"a": (2, 1, [1.0, 1.0]), "b": (1, 0, None), None: (1, 1, [3.0, 3.0])}
    assert SK.estimates(SK.label_sketches(df.limit(0)), [0.5]).count() == 0
    assert SK.estimates(SK.merged(SK.label_sketches(df.limit(0))), [0.5]).first()["quantiles"] is None
