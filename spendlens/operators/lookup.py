"""Majority lookups and the lookup baseline (AGG-4/5, WIN-1, JOI-1/2/6, EVA-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.keys import broadcast_if_small

LABEL = "account_name"


def majority_by(df: DataFrame, key: str, label: str = LABEL, out: str | None = None,
                by: list[str] | None = None) -> DataFrame:
    """Majority label per key (and per ``by`` group, e.g. split_id): highest count, ties ->
    smallest label.

    Two hash aggregations with map-side combine; a hot key is pre-aggregated on every
    mapper, so no key's rows are ever gathered into one task.
    """
    out = out or f"{key}_label"
    by = list(by or [])
    votes = df.groupBy(*by, key, label).agg(F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(*by, key).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias(out),
        F.max("_n").alias(f"{out}_votes"),
        F.sum("_n").alias(f"{key}_rows"),
    )


def global_majority(df: DataFrame, label: str = LABEL) -> str | None:
    """AGG-5: most frequent label, ties -> alphabetically first (one value to the driver)."""
    row = (df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
           .agg(F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("m"))
           .first())
    return row["m"] if row else None


def global_majority_by(df: DataFrame, by: str, label: str = LABEL) -> dict:
    """AGG-5 per group of ``by`` (a handful of splits): {group: (label, count, rows)}."""
    counts = df.groupBy(by, label).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.groupBy(by).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("m"),
        F.max("_n").alias("votes"), F.sum("_n").alias("rows")).collect()
    return {r[by]: (r["m"], r["votes"], r["rows"]) for r in rows}


def _group_lookup(values: dict, by: str) -> F.Column:
    pairs = []
    for g, v in values.items():
        pairs += [F.lit(g), F.lit(v)]
    return F.element_at(F.create_map(*pairs), F.col(by)) if pairs else F.lit(None)


def lookup_predict(train: DataFrame, test: DataFrame, label: str = LABEL,
                   by: str | None = None) -> DataFrame:
    """JOI-1: item majority, else vendor majority, else global majority.

    Empty-string answers fall through like the reference's ``or`` chain. The vendor table
    is broadcast only when its row count is checked small; the item table (one row per
    distinct training item) is joined by a shuffle, skew split by AQE.
    """
    grp = [by] if by else []
    items = majority_by(train, "item_key", label, out="item_label", by=grp).select(
        *grp, "item_key", "item_label")
    vendors = majority_by(train, "vendor_id", label, out="vendor_label", by=grp).select(
        *grp, "vendor_id", "vendor_label")
    if by:
        fallback = _group_lookup({g: v[0] for g, v in global_majority_by(train, by, label).items()}, by)
    else:
        fallback = F.lit(global_majority(train, label))
    pred = F.coalesce(F.nullif(F.col("item_label"), F.lit("")),
                      F.nullif(F.col("vendor_label"), F.lit("")),
                      fallback)
    return (test.join(items, grp + ["item_key"], "left")
            .join(broadcast_if_small(vendors), grp + ["vendor_id"], "left")
            .withColumn("predicted", pred)
            .drop("item_label", "vendor_label"))


def accuracy(pred: DataFrame, label: str = LABEL, predicted: str = "predicted") -> DataFrame:
    """AGG-7: share of rows whose prediction equals the label (one-row frame)."""
    return pred.agg(
        F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("test_rows"),
    )


def vendor_account_map(train: DataFrame, label: str = LABEL) -> DataFrame:
    """Vendor -> majority label of the training rows (ties -> smallest label)."""
    return majority_by(train, "vendor_id", label, out="vendor_label").select(
        "vendor_id", "vendor_label")


def apply_vendor_fallback(pred: DataFrame, vendor_map: DataFrame, threshold: float = 0.5,
                          predicted: str = "predicted", confidence: str = "max_prob") -> DataFrame:
    """JOI-2 / MDL-5: keep the model's answer when confidence >= threshold; otherwise use the
    vendor's mapped label when it exists and is non-empty, else keep the model's answer.
    Adds ``source`` = model | vendor_fallback."""
    joined = pred.join(broadcast_if_small(vendor_map), "vendor_id", "left")
    use_vendor = (F.col(confidence) < F.lit(threshold)) & \
        F.coalesce(F.col("vendor_label") != "", F.lit(False))
    return (joined
            .withColumn("source", F.when(use_vendor, F.lit("vendor_fallback")).otherwise(F.lit("model")))
            .withColumn(predicted, F.when(use_vendor, F.col("vendor_label")).otherwise(F.col(predicted)))
            .drop("vendor_label"))
