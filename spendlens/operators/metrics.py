"""Classification metrics as aggregations (AGG-6..11, PRJ-8..10, JOI-3, SET-2, TOP-2/3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.keys import broadcast_if_small

LABEL = "account_name"

# Training-frequency buckets of the error analysis (0 falls into none).
FREQUENCY_BUCKETS = [
    ("singleton (n=1)", 1, 1),
    ("very_rare (2-4)", 2, 4),
    ("rare (5-19)", 5, 19),
    ("medium (20-99)", 20, 99),
    ("frequent (100+)", 100, None),
]
MIN_SUPPORT_FOR_RANKING = 5


def _safe_div(a, b) -> F.Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def classification_report(pred: DataFrame, label: str = LABEL,
                          predicted: str = "predicted", by: list[str] | None = None) -> DataFrame:
    """Per-label precision, recall, F1 and support over the union of true and predicted
    labels; zero division -> 0. One aggregation of the confusion pairs, then marginals.
    ``by`` computes one report per group (e.g. per split)."""
    by = list(by or [])
    pairs = pred.groupBy(*by, F.col(label).alias("_t"), F.col(predicted).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"))
    # Each pair contributes to its true label and, separately, to its predicted label.
    contrib = pairs.select(*by, 
        F.explode(F.array(
            F.struct(F.col("_t").alias("label"), F.col("_n").alias("support"),
                     F.lit(0).cast("bigint").alias("predicted_n"),
                     F.when(F.col("_t") == F.col("_p"), F.col("_n")).otherwise(0).alias("tp")),
            F.struct(F.col("_p").alias("label"), F.lit(0).cast("bigint").alias("support"),
                     F.col("_n").alias("predicted_n"), F.lit(0).cast("bigint").alias("tp")),
        )).alias("c")).select(*by, "c.*")
    per_label = contrib.groupBy(*by, "label").agg(
        F.sum("support").cast("bigint").alias("support"),
        F.sum("predicted_n").cast("bigint").alias("predicted_n"),
        F.sum("tp").cast("bigint").alias("tp"))
    return per_label.select(
        *by, "label",
        _safe_div(F.col("tp"), F.col("predicted_n")).alias("precision"),
        _safe_div(F.col("tp"), F.col("support")).alias("recall"),
        _safe_div(2 * F.col("tp"), F.col("support") + F.col("predicted_n")).alias("f1"),
        "support",
    )


def report_averages(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """AGG-8: macro and support-weighted averages of precision, recall and F1."""
    total = F.sum("support")
    return report.groupBy(*(by or [])).agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        _safe_div(F.sum(F.col("precision") * F.col("support")), total).alias("weighted_precision"),
        _safe_div(F.sum(F.col("recall") * F.col("support")), total).alias("weighted_recall"),
        _safe_div(F.sum(F.col("f1") * F.col("support")), total).alias("weighted_f1"),
        F.count(F.lit(1)).alias("n_labels"),
    )


def ranked_labels(report: DataFrame, best: bool = True, k: int = 10,
                  min_support: int = MIN_SUPPORT_FOR_RANKING) -> DataFrame:
    """TOP-2/3: best (f1 desc) or worst (f1 asc) labels with support >= 5; ties by support
    desc, label asc. A top-k report: the limit is the feature."""
    f1_order = F.col("f1").desc() if best else F.col("f1").asc()
    return (report.where(F.col("support") >= min_support)
            .orderBy(f1_order, F.col("support").desc(), F.col("label").asc())
            .limit(k))


def frequency_bucket(n) -> F.Column:
    """PRJ-8: bucket name for a training count; NULL for 0 (dropped)."""
    col = F.col(n) if isinstance(n, str) else n
    expr = None
    for name, lo, hi in FREQUENCY_BUCKETS:
        cond = (col >= lo) if hi is None else col.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def error_by_frequency(pred: DataFrame, train: DataFrame, label: str = LABEL,
                       predicted: str = "predicted") -> DataFrame:
    """AGG-9: accuracy of test rows grouped by their label's training frequency."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("_train_n"))
    joined = pred.join(broadcast_if_small(counts), label, "left").withColumn(
        "bucket", frequency_bucket(F.coalesce(F.col("_train_n"), F.lit(0))))
    return (joined.where(F.col("bucket").isNotNull())
            .groupBy("bucket")
            .agg(F.sum((F.col(label) == F.col(predicted)).cast("int")).cast("bigint").alias("correct"),
                 F.count(F.lit(1)).alias("total"))
            .withColumn("accuracy", F.round(F.col("correct") / F.col("total"), 4)))


def evaluation_summary(test_pred: DataFrame, train_pred: DataFrame | None = None,
                       label: str = LABEL, predicted: str = "predicted") -> dict:
    """Scalars of one evaluation (accuracy, F1s, sizes) in a single pass per frame."""
    rep = report_averages(classification_report(test_pred, label, predicted)).first()
    acc = test_pred.agg(
        F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("a"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct(label).alias("labels")).first()
    out = {"accuracy": acc["a"], "test_size": acc["n"], "labels_in_test": acc["labels"],
           "macro_f1": rep["macro_f1"], "weighted_f1": rep["weighted_f1"]}
    if train_pred is not None:
        tr = train_pred.agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("a"),
                            F.count(F.lit(1)).alias("n")).first()
        out["train_accuracy"] = tr["a"]
        out["train_size"] = tr["n"]
        out["accuracy_gap"] = (tr["a"] or 0.0) - (acc["a"] or 0.0)
    return out
