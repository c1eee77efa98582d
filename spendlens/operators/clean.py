"""Cleaning and derived columns of expense rows (SRC-1/2 projection, PRJ-1..7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.functions.text import build_text, normalize_text

EXPENSE_COLUMNS = ["row_id", "vendor_id", "item_name", "item_description", "account_name",
                   "item_total_amount", "item_key", "text", "amount_log"]


def coerce_amount(c) -> F.Column:
    """Numeric coercion: anything that is not a finite-or-infinite number becomes 0.0."""
    col = F.col(c) if isinstance(c, str) else c
    as_double = col.cast("string").try_cast("double")
    return F.when(as_double.isNull() | F.isnan(as_double), F.lit(0.0)).otherwise(as_double)


def clean_expenses(raw: DataFrame, keep_null_labels: bool = False) -> DataFrame:
    """Raw expense schema -> EXPENSE schema.

    Missing optional columns are added as NULL (inference rows). Rows without a label
    are dropped unless ``keep_null_labels`` (they cannot be trained or scored against).
    """
    for name in ["vendor_id", "item_name", "item_description", "account_name",
                 "item_total_amount"]:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("string"))
    if not keep_null_labels:
        raw = raw.where(F.col("account_name").isNotNull())
    amount = coerce_amount("item_total_amount")
    return raw.select(
        "row_id",
        F.coalesce(F.col("vendor_id").cast("string"), F.lit("")).alias("vendor_id"),
        F.coalesce(F.col("item_name").cast("string"), F.lit("")).alias("item_name"),
        F.coalesce(F.col("item_description").cast("string"), F.lit("")).alias("item_description"),
        F.col("account_name").cast("string").alias("account_name"),
        amount.alias("item_total_amount"),
        normalize_text("item_name").alias("item_key"),
        build_text("item_name", "item_description").alias("text"),
        F.log1p(F.abs(amount)).alias("amount_log"),
    )


def inference_rows(df: DataFrame) -> DataFrame:
    """SRC-2: scoring input with camelCase or snake_case keys, missing keys as NULL."""
    renames = {"vendorId": "vendor_id", "itemName": "item_name",
               "itemDescription": "item_description", "accountName": "account_name",
               "itemTotalAmount": "item_total_amount"}
    for src, dst in renames.items():
        if src in df.columns and dst not in df.columns:
            df = df.withColumnRenamed(src, dst)
    if "row_id" not in df.columns:
        df = df.withColumn("row_id", F.lit(None).cast("string"))  # scored like any other row
    return clean_expenses(df, keep_null_labels=True)
