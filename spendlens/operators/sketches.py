"""Mergeable sketches of amounts and items (opt-in approximations of FEA-3 and AGG-2).

The exact queries stay the default: they shuffle every distinct amount, and every distinct
(label, item) pair. A sketch per label is one partial aggregation of bounded state, can be
stored beside a partition of the data, and merges with others later without the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABEL = "account_name"
#: Size of the quantile sketch; the rank of an estimated quantile is off by at most about
#: ``RANK_ERROR`` of all rows (99 % of the time).
QUANTILE_K, RANK_ERROR = 400, 0.007
#: log2 of the buckets of the distinct sketch; its relative standard error is 1.04 / sqrt(2 ** LG_BUCKETS).
LG_BUCKETS = 12
DISTINCT_ERROR = 1.04 / 2 ** (LG_BUCKETS / 2)


def label_sketches(df: DataFrame, label: str = LABEL, item: str = "item_key",
                   amount: str = "amount_log") -> DataFrame:
    """One row per label: ``rows``, ``amounts`` (quantile sketch) and ``items`` (distinct sketch).
    Null amounts and items are in ``rows`` only; a null label is a label of its own."""
    return df.groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"),
        F.kll_sketch_agg_double(F.col(amount).cast("double"), F.lit(QUANTILE_K)).alias("amounts"),
        F.hll_sketch_agg(F.col(item), F.lit(LG_BUCKETS)).alias("items"))


def merged(sketches: DataFrame, *keys: str) -> DataFrame:
    """Sketches put together per ``keys`` (all of them without): of several tables, partitions or labels."""
    return sketches.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.kll_merge_agg_double("amounts").alias("amounts"),
        F.hll_union_agg("items").alias("items"))


def estimates(sketches: DataFrame, fractions: list[float]) -> DataFrame:
    """The sketches replaced by ``unique_items`` and ``quantiles``, one per fraction; without any
    amount the quantiles are null."""
    some = F.kll_sketch_get_n_double("amounts") > 0
    wanted = F.array(*[F.lit(float(f)) for f in fractions])
    return sketches.select(
        *[c for c in sketches.columns if c not in ("amounts", "items")],
        F.hll_sketch_estimate("items").alias("unique_items"),
        F.when(some, F.kll_sketch_get_quantile_double("amounts", wanted)).alias("quantiles"))
