"""Deterministic ordering keys and distributed selection helpers.

* ``order_key``: ``md5('seed:key')`` hex string. md5 hex is identical in Spark and in SQL
  engines, so a split defined by it can be checked by an independent engine, and it does
  not depend on partitioning (unlike ``randomSplit``/``rand``).
* ``kth_smallest``: exact k-th smallest of a hex key per group without a global sort or a
  single-task window: histogram of hash prefixes (bounded: 65,536 buckets per group),
  narrowed until the bucket holding rank k is small, then a bounded top-k.
* ``dense_index``: 0-based global rank after a distributed range sort; only per-partition
  row counts reach the driver.
* ``broadcast_if_small``: broadcast a lookup side only after checking its row count.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_PREFIX_STEP = 4            # hex characters per refinement level (65,536 buckets)
_FINAL_BUCKET_ROWS = 200_000  # rows per group handled by the exact top-k step
DEFAULT_BROADCAST_ROWS = 2_000_000


def order_key(seed, *cols) -> Column:
    """``md5(concat_ws(':', seed, c1, c2, ...))`` as lowercase hex."""
    parts = [F.lit(str(seed)) if not isinstance(seed, Column) else seed.cast("string")]
    parts += [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hex_prefix_int(c, n_hex: int = 7) -> Column:
    """Integer value of the first ``n_hex`` hex digits of an md5 string."""
    col = F.col(c) if isinstance(c, str) else c
    return F.conv(F.substring(col, 1, n_hex), 16, 10).cast("bigint")


def test_count(n: int, fraction: float) -> int:
    """Exact holdout size: ceil(fraction * n), at least 1 when n > 0."""
    if n <= 0:
        return 0
    return max(1, math.ceil(fraction * n - 1e-9))


def kth_smallest(df: DataFrame, key: str, ks: dict, by: str | None = None) -> dict:
    """Exact k-th smallest value of the hex string column ``key`` per group.

    ``ks`` maps group value -> k (use ``{None: k}`` when ``by`` is None). Returns group ->
    cut such that ``key <= cut`` selects exactly k rows of that group (keys are unique).
    """
    found = kth_smallest_many(df, key, {g: [k] for g, k in ks.items()}, by)
    return {g: cut for (g, _), cut in found.items()}


def kth_smallest_many(df: DataFrame, key: str, ks: dict, by: str | None = None) -> dict:
    """Many ranks of many groups at once: ``ks`` maps group -> list of ranks; returns
    (group, rank) -> cut. A rank beyond its group's rows has a cut above every key; ranks
    below 1 have none.

    Each round is one histogram of hash prefixes for all groups and ranks that are not found
    yet (65,536 buckets a group and prefix); once every wanted bucket is small, one job ranks
    the keys of all of them. No group is ever gathered into one task.
    """
    grp = F.col(by).cast("string") if by else F.lit(None).cast("string")
    base = df.select(grp.alias("_g"), F.col(key).alias("_h"))
    name = {(None if g is None else str(g)): g for g in ks}
    pending = {(g, k): (k, "") for g, own in ks.items() for k in own if k and k > 0}
    cuts: dict = {}
    finals: dict = {}

    def wanted(prefixes, length):
        """Rows of one of the (group, prefix) pairs; all prefixes have the same length."""
        if not length:
            return F.lit(True)
        at = F.concat_ws("|", F.coalesce("_g", F.lit("")), F.substring("_h", 1, length))
        return at.isin(sorted({f"{'' if g is None else g}|{p}" for g, p in prefixes}))

    while pending:
        length = len(next(iter(pending.values()))[1])
        hist = (base.where(wanted([(g, p) for (g, _), (_, p) in pending.items()], length))
                .groupBy("_g", F.substring("_h", 1, length + _PREFIX_STEP).alias("_p"))
                .agg(F.count(F.lit(1)).alias("_n")).collect())
        by_group: dict = {}
        for row in hist:
            by_group.setdefault(name.get(row["_g"], row["_g"]), []).append((row["_p"], row["_n"]))
        later: dict = {}
        for (g, k), (rank, prefix) in pending.items():
            for p, n in sorted(x for x in by_group.get(g, []) if x[0].startswith(prefix)):
                if n >= rank:
                    small = n <= _FINAL_BUCKET_ROWS or length + _PREFIX_STEP >= 32
                    (finals if small else later)[g, k] = (rank, p)
                    break
                rank -= n
            else:  # fewer than k rows: everything qualifies
                cuts[g, k] = "g" * 32
        pending = later
    by_length: dict = {}
    for (g, k), (rank, p) in finals.items():
        by_length.setdefault(len(p), {}).setdefault((g, p), []).append((k, rank))
    for length, buckets in by_length.items():
        w = Window.partitionBy("_g", F.substring("_h", 1, length)).orderBy("_h")
        ranks = sorted({r for own in buckets.values() for _, r in own})
        hits = (base.where(wanted(buckets, length)).withColumn("_r", F.row_number().over(w))
                .where(F.col("_r").isin(ranks)).collect())  # ranks x buckets at most
        found = {(name.get(r["_g"], r["_g"]), r["_h"][:length], r["_r"]): r["_h"] for r in hits}
        for (g, p), own in buckets.items():
            for k, rank in own:
                cuts[g, k] = found[g, p, rank]
    return cuts


def cut_column(cuts: dict, by: str | None = None) -> Column:
    """Column holding each row's cut value (a literal, or a small map lookup by group)."""
    if by is None:
        return F.lit(cuts.get(None, ""))
    if not cuts:
        return F.lit(None).cast("string")
    pairs = []
    for g, c in cuts.items():
        pairs += [F.lit(g), F.lit(c)]
    return F.element_at(F.create_map(*pairs), F.col(by))


def dense_index(df: DataFrame, order_cols: list[str], name: str = "idx") -> DataFrame:
    """Attach a 0-based global position in ``order_cols`` order.

    Range-partitioned sort, then ``monotonically_increasing_id`` (partition id in the
    upper bits, position in the lower 33 bits). The driver only sees one count per
    partition to turn positions into global offsets.
    """
    sorted_df = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    sorted_df = sorted_df.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    # The ids depend on the physical partitioning of this one execution: write it once to
    # the shared checkpoint folder (survives executor loss, never recomputed differently).
    from spendlens.session import materialize
    sorted_df = materialize(sorted_df)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, running = {}, 0
    for row in sorted(counts, key=lambda r: r["_pid"]):
        offsets[row["_pid"]] = running
        running += row["n"]
    if offsets:
        pairs = []
        for pid, off in offsets.items():
            pairs += [F.lit(pid), F.lit(off)]
        offset_col = F.element_at(F.create_map(*pairs), F.col("_pid"))
    else:
        offset_col = F.lit(0).cast("bigint")
    pos = F.col("_mid") - F.shiftleft(F.col("_pid"), 33)
    return sorted_df.withColumn(name, (offset_col + pos).cast("bigint")).drop("_mid", "_pid")


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                       known_rows: int | None = None) -> DataFrame:
    """Broadcast-hint ``df`` only when its row count is proven to be <= ``max_rows``.

    Beyond the bound the plain frame is returned and the planner shuffles (with AQE skew
    splitting); nothing unbounded is ever broadcast.
    """
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df


def top_per_group(df: DataFrame, group_cols: list[str], order_cols: list, k: int,
                  rank_name: str = "rn") -> DataFrame:
    """Rows ranked 1..k per group. ``row_number() <= k`` lets Spark insert a partial
    window-group-limit before the shuffle, so each map task ships at most k rows per
    group even for a group that holds a large share of all rows."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)
