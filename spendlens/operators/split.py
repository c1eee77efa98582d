"""Leakage-safe splits, resampling and ordered selections (SPL-1..7, WIN-2..5, SET-1/3, JOI-4/5).

Every random choice of the reference is replaced by an order on ``md5('seed:key')``; the
same rule is written in SQL by the oracle. Splits are expressed as a ``split`` column
(``train`` / ``test`` / ``dropped``) so that a plan never needs positional indices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.keys import (
    broadcast_if_small,
    cut_column,
    dense_index,
    hex_prefix_int,
    kth_smallest,
    kth_smallest_many,
    order_key,
    test_count,
    top_per_group,
)
from spendlens.session import write_table

LABEL = "account_name"
GROUP = "item_key"

# Fixed values of the reference's evaluation protocol.
DEFAULT_SEED = 42
TEST_FRACTION = 0.2
SAMPLES_PER_CLASS = 3
MIN_TRAIN_SIZE = 5
LEARNING_FRACTIONS = [0.2, 0.4, 0.6, 0.8, 1.0]
# Upper bound on the number of distinct labels before lookup tables stop being broadcast.
MAX_BROADCAST_LABELS = 1_000_000


def _split_col(is_test) -> F.Column:
    return F.when(is_test, F.lit("test")).otherwise(F.lit("train"))


def random_split(df: DataFrame, seed: int = DEFAULT_SEED, fraction: float = TEST_FRACTION,
                 key: str = "row_id") -> DataFrame:
    """SPL-1: the ceil(fraction * N) rows with the smallest md5(seed:row_id) are test."""
    h = order_key(seed, key)
    n = df.count()
    cuts = kth_smallest(df.withColumn("_h", h), "_h", {None: test_count(n, fraction)})
    return df.withColumn("split", _split_col(h <= cut_column(cuts)))


def group_split(df: DataFrame, seed: int = DEFAULT_SEED, fraction: float = TEST_FRACTION,
                group: str = GROUP) -> DataFrame:
    """SPL-2: ceil(fraction * G) whole groups (smallest md5(seed:group)) are test.

    Membership is a pure function of the group's own hash, so after the cut is known the
    rows are labelled without a join or shuffle.
    """
    groups = df.select(group).distinct().withColumn("_h", order_key(seed, group))
    g = groups.count()
    cuts = kth_smallest(groups, "_h", {None: test_count(g, fraction)})
    return df.withColumn("split", _split_col(order_key(seed, group) <= cut_column(cuts)))


def repeated_split(df: DataFrame, n_splits: int = 5, seed: int = DEFAULT_SEED,
                   fraction: float = TEST_FRACTION, group: str | None = GROUP,
                   key: str = "row_id") -> DataFrame:
    """SPL-3: ``n_splits`` independent splits; split i uses seed + i.

    Output has one row per (split_id, input row). With ``group=None`` the splits are row
    splits (repeated SPL-1).
    """
    unit = group or key
    units = df.select(unit).distinct() if group else df.select(unit)
    units = units.withColumn("split_id", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    seed_col = F.lit(seed) + F.col("split_id")
    units = units.withColumn("_h", order_key(seed_col, unit))
    n_units = df.select(unit).distinct().count() if group else df.count()
    k = test_count(n_units, fraction)
    cuts = kth_smallest(units, "_h", {i: k for i in range(n_splits)}, by="split_id")
    rows = df.withColumn("split_id", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    is_test = order_key(seed_col, unit) <= cut_column(cuts, "split_id")
    return rows.withColumn("split", _split_col(is_test))


def stratified_group_folds(df: DataFrame, n_folds: int = 3, seed: int = DEFAULT_SEED,
                           group: str = GROUP, label: str = LABEL) -> DataFrame:
    """SPL-4: whole groups dealt to folds 0..n-1 so that every fold has its share of every label.

    A group's label vector is its row count per label. Groups are ordered by their dominant
    label (most rows, ties -> smallest label), then its row count, largest first, then the
    whole vector, then md5(seed:group), and dealt in turn over all of them. So equal vectors
    stand together and go to the folds evenly, the largest groups of a label go first, and
    each label goes on with the fold that the label before it left short. Bounds, between any
    two folds: the rows that groups hold of their dominant label differ, per label, by at
    most the label's largest group; the number of groups of one vector by at most one, and
    so does the number of all groups.

    The vector enters the order as a sum of hashes, one number a group however many labels it
    has. Positions come from one range sort of the groups, so no window holds a label.
    """
    votes = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("_n"))
    vectors = votes.groupBy(group).agg(
        F.min_by(F.col(label), F.struct(-F.col("_n"), F.col(label))).alias("_dom"),
        F.max("_n").alias("_most"),
        F.sum(hex_prefix_int(order_key(seed, label, "_n"))).alias("_vector"))
    placed = dense_index(vectors.select(group, "_dom", (-F.col("_most")).alias("_size"), "_vector",
                                        order_key(seed, group).alias("_h")),
                         ["_dom", "_size", "_vector", "_h"], "_at")
    folds = placed.select(group, F.pmod(F.col("_at"), F.lit(n_folds)).cast("int").alias("fold"))
    return df.join(folds, group)


def balanced_unseen_split(df: DataFrame, seed: int = DEFAULT_SEED,
                          samples_per_class: int = SAMPLES_PER_CLASS,
                          min_train_size: int = MIN_TRAIN_SIZE, strict: bool = False,
                          label: str = LABEL, group: str = GROUP) -> DataFrame:
    """SPL-5: per label, hold out ``samples_per_class`` rows whose (label, item) groups are
    removed from training entirely.

    Rules: (a) label total - k >= min_train_size; (b) the groups taken in md5(seed:label:item)
    order until their rows reach k; (c) those groups must not be all of the label's groups;
    (d) every row of a taken group leaves train, k of them (md5(seed:row_id) order) are
    test, the rest are ``dropped``; (e) other labels stay in train in full.
    ``strict=True`` also drops training rows whose item appears in test under any label.

    Each group has >= 1 row, so the prefix holds at most k groups: a top-k per label (with a
    partial limit before the shuffle) replaces a window over a whole label.
    """
    return _balanced(df, [seed], samples_per_class, min_train_size, strict, label, group).drop("repeat")


def balanced_repeated_split(df: DataFrame, repeats: int = 5, seed: int = DEFAULT_SEED,
                            samples_per_class: int = SAMPLES_PER_CLASS,
                            min_train_size: int = MIN_TRAIN_SIZE, strict: bool = False,
                            label: str = LABEL, group: str = GROUP) -> DataFrame:
    """SPL-6: balanced unseen splits for seeds seed..seed+repeats-1, tagged by ``repeat``: one
    plan in which the seed is a column."""
    return _balanced(df, [seed + r for r in range(repeats)], samples_per_class, min_train_size, strict, label, group)


def _balanced(df: DataFrame, seeds: list[int], k: int, min_train_size: int, strict: bool,
              label: str, group: str) -> DataFrame:
    """``balanced_unseen_split`` for every seed, as ``repeat`` 0, 1, ...

    The table of (label, item) sizes is written once; seeds multiply it, not the rows. What
    is held out (at most k groups and k rows a label and seed) is written too, so neither is
    computed again when its size is checked.
    """
    repeat = F.explode(F.sequence(F.lit(0), F.lit(len(seeds) - 1))).alias("repeat")
    seed = F.lit(seeds[0]) + F.col("repeat")
    sizes = write_table(df.groupBy(label, group).agg(F.count(F.lit(1)).alias("_sz")), "label-items")
    per_label = sizes.groupBy(label).agg(F.sum("_sz").alias("_total"), F.count(F.lit(1)).alias("_ngroups"))
    groups = sizes.select("*", repeat).withColumn("_gh", order_key(seed, label, group))
    first_k = top_per_group(groups, ["repeat", label], ["_gh"], k, rank_name="_gr")
    w = Window.partitionBy("repeat", label).orderBy("_gh").rowsBetween(Window.unboundedPreceding, 0)
    prefix = first_k.withColumn("_cum", F.sum("_sz").over(w)).where(F.col("_cum") - F.col("_sz") < k)
    taken = prefix.groupBy("repeat", label).agg(F.count(F.lit(1)).alias("_nsel"), F.max("_cum").alias("_reach"))
    eligible = (taken.join(per_label, label)
                .where((F.col("_total") - k >= min_train_size) & (F.col("_reach") >= k)
                       & (F.col("_nsel") < F.col("_ngroups"))).select("repeat", label))
    selected = write_table(prefix.join(eligible, ["repeat", label], "left_semi").select("repeat", label, group), "held-groups")
    selected = broadcast_if_small(selected, max_rows=MAX_BROADCAST_LABELS)
    cand = df.select("row_id", label, group).join(selected, [label, group])
    test_ids = write_table(top_per_group(cand.withColumn("_rh", order_key(seed, "row_id")), ["repeat", label], ["_rh"], k,
                                         rank_name="_tr").select("repeat", "row_id", F.lit(True).alias("_test")), "test-rows")
    test_ids = broadcast_if_small(test_ids, max_rows=MAX_BROADCAST_LABELS)
    marked = df.select("*", repeat).join(selected.withColumn("_sel", F.lit(True)), ["repeat", label, group], "left")
    # Only rows of the selected groups are matched against the (bounded) test ids; all
    # other rows are training rows without any further join.
    held = (marked.where(F.col("_sel").isNotNull()).drop("_sel").join(test_ids, ["repeat", "row_id"], "left")
            .withColumn("split", F.when(F.col("_test").isNotNull(), F.lit("test"))
                        .otherwise(F.lit("dropped"))).drop("_test"))
    kept = marked.where(F.col("_sel").isNull()).drop("_sel").withColumn("split", F.lit("train"))
    out = kept.unionByName(held.select(*kept.columns))
    if strict:
        test_items = out.where(F.col("split") == "test").select("repeat", group).distinct()
        out = (out.join(test_items.withColumn("_seen", F.lit(True)), ["repeat", group], "left")
               .withColumn("split", F.when((F.col("split") == "train") & F.col("_seen").isNotNull(),
                                           F.lit("dropped")).otherwise(F.col("split")))
               .drop("_seen"))
    return out


def oversample_minority(df: DataFrame, min_count: int = 10, seed: int = DEFAULT_SEED,
                        label: str = LABEL) -> DataFrame:
    """SPL-7: add copies so each label has >= min_count rows (training rows only).

    Copy i of a label with n rows repeats the label's row of rank
    1 + (hex7(md5(seed:label:i)) mod n), rows ranked by md5(seed:row_id). Only minority
    labels (< min_count rows) are ranked, so every window is smaller than min_count.
    Output: input rows with ``copy_no = 0`` plus the copies with ``copy_no = 1..deficit``.
    """
    base = df.withColumn("copy_no", F.lit(0))
    if min_count <= 0:
        return base
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    minority = counts.where(F.col("_n") < min_count)
    minority = broadcast_if_small(minority, max_rows=MAX_BROADCAST_LABELS)
    ranked = (df.join(minority, label, "left_semi")
              .withColumn("_r", F.row_number().over(
                  Window.partitionBy(label).orderBy(order_key(seed, "row_id"), "row_id"))))
    copies = (minority.withColumn("copy_no", F.explode(F.sequence(F.lit(1), min_count - F.col("_n"))))
              .withColumn("_r", 1 + F.pmod(hex_prefix_int(order_key(seed, label, "copy_no")),
                                           F.col("_n")).cast("int"))
              .select(label, "copy_no", "_r"))
    added = ranked.join(copies, [label, "_r"]).drop("_r")
    return base.unionByName(added.select(*base.columns))


def learning_prefixes(train: DataFrame, fractions=LEARNING_FRACTIONS, seed: int = DEFAULT_SEED,
                      by: str = "split_id") -> DataFrame:
    """WIN-4: nested training prefixes. For each ``by`` group with n training rows, the
    prefix of fraction f holds the int(f * n) rows with the smallest md5(seed:row_id)."""
    keyed = train.withColumn("_h", order_key(seed, "row_id"))
    sizes = {r[by]: r["n"] for r in keyed.groupBy(by).agg(F.count(F.lit(1)).alias("n")).collect()}
    ks = {g: [int(f * n) for f in fractions] for g, n in sizes.items()}
    cuts = kth_smallest_many(keyed, "_h", ks, by=by)
    # One scan: a row is in every prefix whose cut it does not exceed.
    inside = []
    for i, f in enumerate(fractions):
        cut = cut_column({g: cuts.get((g, own[i]), "") for g, own in ks.items()}, by)
        inside.append(F.when(F.col("_h") <= cut, F.lit(float(f))))
    of = F.filter(F.array(*inside), lambda x: x.isNotNull())
    return keyed.withColumn("train_fraction", F.explode(of)).drop("_h")
