"""Dataset profile, EDA series, validation and fingerprint (AGG-1..3, 13..15, TOP-1/6,
TRK-1, SNK-5, SET-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.text import is_blank

LABEL = "account_name"

# Fixed values of the exploratory series.
LABEL_SIZE_BUCKETS = [("<3", None, 3), ("3-4", 3, 5), ("5-9", 5, 10), (">=10", 10, None)]
HISTOGRAM_BINS = 40


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    """AGG-1: rows per value (hash aggregate with map-side combine)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, col: str, k: int) -> DataFrame:
    """TOP-1/6: the k most frequent values, ties by value ascending (a top-k report)."""
    order = [F.col("n").desc(), F.col(col).asc()]
    # The window runs over the k rows left after the limit only.
    return (value_counts(df, col).orderBy(*order).limit(k)
            .withColumn("rank", F.row_number().over(Window.orderBy(*order))))


def items_per_label(df: DataFrame, label: str = LABEL, item: str = "item_key") -> DataFrame:
    """AGG-2: distinct items per label (exact; distinct (label, item) pairs first)."""
    return (df.select(label, item).distinct().groupBy(label)
            .agg(F.count(F.lit(1)).alias("unique_items")))


def dataset_profile(df: DataFrame, label: str = LABEL) -> DataFrame:
    """AGG-3: one row of dataset counts. Per-label stats come from one aggregation over
    (label, item) pairs, the global ones from one pass over the rows."""
    per_pair = df.groupBy(label, "item_key").agg(F.count(F.lit(1)).alias("_n"))
    per_label = per_pair.groupBy(label).agg(F.sum("_n").alias("_n"),
                                            F.count(F.lit(1)).alias("_items"))
    lab = per_label.agg(
        F.count(F.lit(1)).alias("unique_account_names"),
        F.count_if(F.col("_n") < 10).alias("labels_lt_10"),
        F.count_if(F.col("_n") < 5).alias("labels_lt_5"),
        F.count_if(F.col("_n") < 3).alias("labels_lt_3"),
        F.count_if(F.col("_n") == 1).alias("singleton_labels"),
        F.count_if(F.col("_items") == 1).alias("labels_with_one_unique_item"),
        F.count_if(F.col("_items") < 3).alias("labels_with_lt_3_unique_items"),
    )
    rows = df.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct("vendor_id").alias("unique_vendors"),
        F.count_if(is_blank("item_description")).alias("missing_item_descriptions"),
        F.min("item_total_amount").alias("min_amount"),
        F.max("item_total_amount").alias("max_amount"),
    )
    # The label statistics are one row of seven counts: carried over as literals.
    stats = lab.first().asDict()
    return rows.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in stats.items()])


def label_size_buckets(df: DataFrame, label: str = LABEL) -> DataFrame:
    """AGG-14: number of labels per class-size bucket (empty buckets omitted)."""
    n = F.col("n")
    expr = None
    for name, lo, hi in LABEL_SIZE_BUCKETS:
        cond = (n < hi) if lo is None else ((n >= lo) if hi is None else ((n >= lo) & (n < hi)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return (value_counts(df, label).withColumn("bucket", expr)
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("labels"),
                                   F.sum("n").cast("bigint").alias("rows")))


def histogram(df: DataFrame, col: str, bins: int = HISTOGRAM_BINS, series: str | None = None) -> DataFrame:
    """AGG-15: equal-width histogram between min and max; the maximum lands in the last bin.
    Non-empty bins only; ``lo``/``hi`` are the bin edges."""
    stats = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = stats["lo"], stats["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame(
            [], "series string, bin int, lo double, hi double, n bigint")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    b = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("int")
    return (df.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(series or col).alias("series"), "bin",
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lo"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("hi"), "n"))


def validate_dataset(df: DataFrame, required_columns: list[str], min_rows: int = 1) -> DataFrame:
    """TRK-1 / AGG-13 / SET-4: rows (column_name, null_count, row_count) of the required
    columns, from one aggregation. An absent column or too few rows is an error."""
    absent = sorted(set(required_columns).difference(df.columns))
    if absent:
        raise ValueError("missing required columns: " + ", ".join(absent))
    counted = null_counts(df, required_columns).collect()  # one row per required column
    if any(r["row_count"] < min_rows for r in counted):
        raise ValueError(f"{counted[0]['row_count']} rows, need >= {min_rows}")
    return df.sparkSession.createDataFrame(counted, "column_name string, null_count bigint, row_count bigint")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-13 as a distributed plan: one aggregation, unpivoted to (column_name, null_count)."""
    agg = df.agg(F.count(F.lit(1)).alias("row_count"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return agg.unpivot(["row_count"], columns, "column_name", "null_count").select(
        "column_name", F.col("null_count").cast("bigint").alias("null_count"), "row_count")


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """SNK-5: order-independent digest of the multiset of rows: their number and the sum of a
    60-bit md5 prefix of each, modulo 2**60. Equal rows add up instead of cancelling, and a
    null is no empty string."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null")) for c in columns]
    row_hash = F.conv(F.substring(F.md5(F.concat_ws("|", *values)), 1, 15), 16, 10).cast("decimal(20,0)")
    total = F.coalesce(F.sum(row_hash), F.lit(0).cast("decimal(30,0)"))
    return df.agg(F.count(F.lit(1)).alias("row_count"), (total % F.lit(2**60).cast("decimal(20,0)")).cast("bigint").alias("digest"))


def log_dataset(df: DataFrame, path: str, name: str, columns: list[str], targets: str, context: str) -> None:
    """SNK-5: one row of the append-only ``datasets`` table: name, digest, row count, schema,
    target column and what the data was used for."""
    row = fingerprint(df, columns)
    (row.select(F.lit(name).alias("name"), "digest", "row_count", F.lit(df.schema.simpleString()).alias("schema"),
                F.lit(targets).alias("targets"), F.lit(context).alias("context")).write.mode("append").parquet(path))
