import pytest

from spendlens.operators import metrics as M

from conftest import rows


def test_report_edges(spark):
    # label "b" is never predicted, "x" is predicted only, a class is named "accuracy"
    pred = spark.createDataFrame(
        [("a", "a"), ("a", "x"), ("b", "a"), ("accuracy", "accuracy")],
        "account_name string, predicted string")
    rep = {r["label"]: r for r in M.classification_report(pred).collect()}
    assert set(rep) == {"a", "b", "x", "accuracy"}
    assert rep["a"]["precision"] == pytest.approx(0.5) and rep["a"]["recall"] == pytest.approx(0.5)
    assert rep["b"]["f1"] == 0.0 and rep["x"]["support"] == 0 and rep["x"]["precision"] == 0.0
    avg = M.report_averages(M.classification_report(pred)).first()
    assert avg["macro_f1"] == pytest.approx((0.5 + 0 + 0 + 1) / 4)
    assert avg["weighted_f1"] == pytest.approx((0.5 * 2 + 0 + 1) / 4)


def test_frequency_buckets_drop_zero(spark):
    train = spark.createDataFrame([("a",)] * 1 + [("b",)] * 4 + [("c",)] * 100, "account_name string")
    test = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("z", "c")],
                                 "account_name string, predicted string")
    got = {r["bucket"]: (r["correct"], r["total"]) for r in M.error_by_frequency(test, train).collect()}
    assert got == {"singleton (n=1)": (1, 1), "very_rare (2-4)": (0, 1), "frequent (100+)": (1, 1)}


def test_ranked_labels_support_floor(spark):
    rep = spark.createDataFrame([("a", 0.9, 5), ("b", 0.9, 7), ("c", 1.0, 4)],
                                "label string, f1 double, support long")
    assert [r["label"] for r in M.ranked_labels(rep).collect()] == ["b", "a"]
    assert [r["label"] for r in M.ranked_labels(rep, best=False).collect()] == ["b", "a"]
