"""Expense-shaped views over the driver tables.

Both views produce the raw expense schema: ``row_id, vendor_id, item_name,
item_description, account_name, item_total_amount``. The same definitions exist as SQL
in ``spendlens.plans.oracle`` so that an independent engine can check every query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.sources.tables import read_table

RAW_COLUMNS = ["row_id", "vendor_id", "item_name", "item_description", "account_name",
               "item_total_amount"]


def _after_first_line(text: Column) -> Column:
    """All of the text behind its first newline; empty for a single line, null for null."""
    at = F.locate("\n", text)
    return F.when(at > 0, F.substr(text, at + 1, F.length(text))).when(text.isNotNull(), F.lit(""))


def expense_view_d(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View D: documents as expense rows (text and vendor signal, long-tailed labels). The
    first line is the item, everything behind it the description: whole texts."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    return docs.select(
        F.col("doc_id").alias("row_id"),
        F.col("source").alias("vendor_id"),
        F.split_part(F.col("text"), F.lit("\n"), F.lit(1)).alias("item_name"),
        _after_first_line(F.col("text")).alias("item_description"),
        F.concat(F.col("lang"), F.lit("-"), F.col("source")).alias("account_name"),
        F.col("n_chars").cast("double").alias("item_total_amount"),
    )


def expense_view_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View L: lineitem joined to part (volume, joins, signed amounts)."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
                     "l_returnflag"])
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_brand"])
    # part is a dimension table (20k rows at sf0.1, ~200k x sf in general); the planner
    # broadcasts it while it stays under spark.sql.autoBroadcastJoinThreshold and
    # falls back to a shuffled join beyond it.
    joined = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("row_id"),
        F.col("l_suppkey").cast("string").alias("vendor_id"),
        F.col("p_name").alias("item_name"),
        F.concat(F.col("p_type"), F.lit(" "), F.col("p_brand")).alias("item_description"),
        F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")).alias("account_name"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
         .otherwise(F.col("l_extendedprice")).alias("item_total_amount"),
    )


def raw_view(spark: SparkSession, sf_dir: str, view: str = "D") -> DataFrame:
    if view.upper() == "D":
        return expense_view_d(spark, sf_dir)
    if view.upper() == "L":
        return expense_view_l(spark, sf_dir)
    raise ValueError(f"unknown view {view!r}")
