"""Registered queries: Spark builders and their oracle SQL, keyed by the same name.

Every query reads the driver tables of ``sf_dir`` in full (through view D or view L) and
returns a DataFrame; floating results are rounded to 6 digits in both engines so an
independent engine can compare values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators import clean as C
from spendlens.operators import lookup as LK
from spendlens.operators import metrics as M
from spendlens.operators import profile as P
from spendlens.operators import tfidf as TF
from spendlens.operators import features as FE
from spendlens.operators import sketches as SK
from spendlens.operators import split as S
from spendlens.operators import tracking as TK
from spendlens.operators import train as TR
from spendlens.plans import evaluate as EV
from spendlens.plans import oracle as O
from spendlens.plans import summary as SM
from spendlens.sources.views import raw_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def expenses(spark: SparkSession, sf_dir: str, view: str = "D") -> DataFrame:
    return C.clean_expenses(raw_view(spark, sf_dir, view))


#: What splits and lookups read: whole texts stay where they are.
KEYS = ["row_id", "vendor_id", "item_key", "account_name"]


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- cleaning (SRC, PRJ)

@register("clean_expenses", (
    f"SELECT row_id, vendor_id, item_key, text, account_name, item_total_amount, "
    f"round(amount_log, 6) AS amount_log FROM ({O.clean('D')}) c"))
def q_clean_expenses(spark, sf_dir):
    return expenses(spark, sf_dir).select(
        "row_id", "vendor_id", "item_key", "text", "account_name", "item_total_amount",
        r6("amount_log").alias("amount_log"))


@register("clean_expenses_l", (
    f"SELECT row_id, vendor_id, item_key, text, account_name, "
    f"round(item_total_amount, 6) AS item_total_amount, round(amount_log, 6) AS amount_log "
    f"FROM ({O.clean('L')}) c"))
def q_clean_expenses_l(spark, sf_dir):
    return expenses(spark, sf_dir, "L").select(
        "row_id", "vendor_id", "item_key", "text", "account_name",
        r6("item_total_amount").alias("item_total_amount"), r6("amount_log").alias("amount_log"))


# ---------------------------------------------------------------- splits (SPL)

@register("split_random", f"SELECT row_id, account_name, split FROM ({O.with_random_split('D')}) s")
def q_split_random(spark, sf_dir):
    return S.random_split(expenses(spark, sf_dir)).select("row_id", "account_name", "split")


@register("split_group", f"SELECT row_id, item_key, split FROM ({O.with_group_split('D')}) s")
def q_split_group(spark, sf_dir):
    return S.group_split(expenses(spark, sf_dir)).select("row_id", "item_key", "split")


# ---------------------------------------------------------------- lookup baseline (EVA-4)

@register("item_majority", (
    f"WITH s AS ({O.with_random_split('D')}), tr AS (SELECT * FROM s WHERE split = 'train') "
    f"{O.majority('tr', 'item_key', 'item_label')}"))
def q_item_majority(spark, sf_dir):
    train = S.random_split(expenses(spark, sf_dir)).where("split = 'train'")
    return LK.majority_by(train, "item_key", out="item_label").select("item_key", "item_label")


@register("vendor_majority", (
    f"WITH s AS ({O.with_random_split('D')}), tr AS (SELECT * FROM s WHERE split = 'train') "
    f"{O.majority('tr', 'vendor_id', 'vendor_label')}"))
def q_vendor_majority(spark, sf_dir):
    train = S.random_split(expenses(spark, sf_dir)).where("split = 'train'")
    return LK.vendor_account_map(train)


def _baseline(spark, sf_dir, view="D", split="random"):
    df = expenses(spark, sf_dir, view).select(*KEYS)
    s = S.random_split(df) if split == "random" else S.group_split(df)
    s = s
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    return LK.lookup_predict(train, test), train


@register("baseline_predictions", (
    O.lookup_predictions(O.with_random_split("D"))
    + "SELECT row_id, account_name, predicted FROM p"))
def q_baseline_predictions(spark, sf_dir):
    pred, _ = _baseline(spark, sf_dir)
    return pred.select("row_id", "account_name", "predicted")


@register("baseline_accuracy", (
    O.lookup_predictions(O.with_random_split("D"))
    + "SELECT round(avg(CAST(account_name = predicted AS DOUBLE)), 6) AS accuracy, "
      "count(*) AS test_rows FROM p"))
def q_baseline_accuracy(spark, sf_dir):
    pred, _ = _baseline(spark, sf_dir)
    return LK.accuracy(pred).select(r6("accuracy").alias("accuracy"), "test_rows")


@register("baseline_accuracy_l", (
    O.lookup_predictions(O.with_random_split("L"))
    + "SELECT round(avg(CAST(account_name = predicted AS DOUBLE)), 6) AS accuracy, "
      "count(*) AS test_rows FROM p"))
def q_baseline_accuracy_l(spark, sf_dir):
    pred, _ = _baseline(spark, sf_dir, view="L")
    return LK.accuracy(pred).select(r6("accuracy").alias("accuracy"), "test_rows")


# ---------------------------------------------------------------- profile (AGG-1..3, 14, 15, TOP-1/6)

_PROFILE_SQL = f"""
WITH c AS ({O.clean('D')}),
pl AS (SELECT account_name, sum(n) AS n, count(*) AS items
       FROM (SELECT account_name, item_key, count(*) AS n FROM c GROUP BY ALL) p GROUP BY 1)
SELECT (SELECT count(*) FROM c) AS record_count,
       (SELECT count(DISTINCT vendor_id) FROM c) AS unique_vendors,
       (SELECT count(*) FILTER (WHERE {O.blank('item_description')}) FROM c) AS missing_item_descriptions,
       (SELECT min(item_total_amount) FROM c) AS min_amount,
       (SELECT max(item_total_amount) FROM c) AS max_amount,
       (SELECT count(*) FROM pl) AS unique_account_names,
       (SELECT count(*) FILTER (WHERE n < 10) FROM pl) AS labels_lt_10,
       (SELECT count(*) FILTER (WHERE n < 5) FROM pl) AS labels_lt_5,
       (SELECT count(*) FILTER (WHERE n < 3) FROM pl) AS labels_lt_3,
       (SELECT count(*) FILTER (WHERE n = 1) FROM pl) AS singleton_labels,
       (SELECT count(*) FILTER (WHERE items = 1) FROM pl) AS labels_with_one_unique_item,
       (SELECT count(*) FILTER (WHERE items < 3) FROM pl) AS labels_with_lt_3_unique_items
"""


@register("dataset_profile", _PROFILE_SQL)
def q_dataset_profile(spark, sf_dir):
    return P.dataset_profile(expenses(spark, sf_dir))


@register("dataset_profile_l", _PROFILE_SQL.replace(O.clean('D'), O.clean('L')))
def q_dataset_profile_l(spark, sf_dir):
    return P.dataset_profile(expenses(spark, sf_dir, "L"))


@register("label_counts", f"SELECT account_name, count(*) AS n FROM ({O.clean('D')}) c GROUP BY 1")
def q_label_counts(spark, sf_dir):
    return P.value_counts(expenses(spark, sf_dir), "account_name")


@register("vendor_counts", f"SELECT vendor_id, count(*) AS n FROM ({O.clean('L')}) c GROUP BY 1")
def q_vendor_counts(spark, sf_dir):
    return P.value_counts(expenses(spark, sf_dir, "L"), "vendor_id")


def _top_sql(view_name, col, k):
    return (f"SELECT {col}, n, row_number() OVER (ORDER BY n DESC, {col}) AS rank FROM "
            f"(SELECT {col}, count(*) AS n FROM ({O.clean(view_name)}) c GROUP BY 1) v "
            f"ORDER BY n DESC, {col} LIMIT {k}")


def _top_spark(df, col, k):
    return P.top_values(df, col, k).select(col, "n", F.col("rank").cast("bigint").alias("rank"))


@register("top_accounts", _top_sql("D", "account_name", 10))
def q_top_accounts(spark, sf_dir):
    return _top_spark(expenses(spark, sf_dir), "account_name", 10)


@register("top_labels_20", _top_sql("L", "account_name", 20))
def q_top_labels_20(spark, sf_dir):
    return _top_spark(expenses(spark, sf_dir, "L"), "account_name", 20)


@register("top_vendors", _top_sql("L", "vendor_id", 15))
def q_top_vendors(spark, sf_dir):
    return _top_spark(expenses(spark, sf_dir, "L"), "vendor_id", 15)


@register("items_per_label", (
    f"SELECT account_name, count(DISTINCT item_key) AS unique_items FROM ({O.clean('D')}) c GROUP BY 1"))
def q_items_per_label(spark, sf_dir):
    return P.items_per_label(expenses(spark, sf_dir))


@register("label_freq_buckets", (
    f"SELECT CASE WHEN n < 3 THEN '<3' WHEN n < 5 THEN '3-4' WHEN n < 10 THEN '5-9' ELSE '>=10' END "
    f"AS bucket, count(*) AS labels, CAST(sum(n) AS BIGINT) AS rows FROM "
    f"(SELECT account_name, count(*) AS n FROM ({O.clean('D')}) c GROUP BY 1) v GROUP BY 1"))
def q_label_freq_buckets(spark, sf_dir):
    return P.label_size_buckets(expenses(spark, sf_dir))


def _hist_sql(col, series):
    return (f"SELECT '{series}' AS series, b AS bin, round(lo + b * ((hi - lo) / 40), 6) AS lo, "
            f"round(lo + (b + 1) * ((hi - lo) / 40), 6) AS hi, count(*) AS n FROM ("
            f"SELECT CAST(least(floor(({col} - lo) / (hi - lo) * 40), 39) AS INTEGER) AS b, lo, hi "
            f"FROM c, (SELECT min({col}) AS lo, max({col}) AS hi FROM c) s) t GROUP BY b, lo, hi")


@register("amount_histogram", (
    f"WITH c AS ({O.clean('L')}) {_hist_sql('item_total_amount', 'amount')} "
    f"UNION ALL {_hist_sql('amount_log', 'amount_log')}"))
def q_amount_histogram(spark, sf_dir):
    df = expenses(spark, sf_dir, "L").select("item_total_amount", "amount_log")
    out = P.histogram(df, "item_total_amount", series="amount").unionByName(
        P.histogram(df, "amount_log", series="amount_log"))
    return out.select("series", "bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


_REQUIRED = ["row_id", "vendor_id", "item_name", "item_description", "account_name",
             "item_total_amount"]


@register("dataset_validation", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
    f"count(*) AS row_count FROM ({O.view('L')}) v" for c in _REQUIRED))
def q_dataset_validation(spark, sf_dir):
    return P.validate_dataset(raw_view(spark, sf_dir, "L"), _REQUIRED)


_FP_COLS = ["row_id", "vendor_id", "item_key", "account_name", "amount_cents"]


@register("dataset_fingerprint", (
    "SELECT count(*) AS row_count, CAST(coalesce(sum(CAST(('0x' || substr(md5(concat_ws('|', "
    + ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), 'null')" for c in (
        "row_id", "vendor_id", "item_key", "account_name", "CAST(round(item_total_amount * 100) AS BIGINT)"))
    + ")), 1, 15)) AS BIGINT)), 0) % 1152921504606846976 AS BIGINT) "
    + f"AS digest FROM ({O.clean('D')}) c"))
def q_dataset_fingerprint(spark, sf_dir):
    df = expenses(spark, sf_dir).withColumn(
        "amount_cents", F.round(F.col("item_total_amount") * 100).cast("bigint"))
    return P.fingerprint(df, _FP_COLS)


# ---------------------------------------------------------------- more splits (SPL-3..7)

_GROUP_REPEATED_SQL = f"""
WITH c AS ({O.clean('D')}),
gs AS (SELECT CAST(s.i AS INTEGER) AS split_id, g.item_key,
              md5(CAST(42 + s.i AS VARCHAR) || ':' || g.item_key) AS h
       FROM (SELECT DISTINCT item_key FROM c) g, (SELECT unnest(range(5)) AS i) s),
t AS (SELECT split_id, item_key, row_number() OVER (PARTITION BY split_id ORDER BY h)
             <= ceil(0.2 * count(*) OVER (PARTITION BY split_id)) AS is_test FROM gs)
"""


@register("split_group_repeated", _GROUP_REPEATED_SQL + (
    "SELECT t.split_id, c.row_id, CASE WHEN is_test THEN 'test' ELSE 'train' END AS split "
    "FROM c JOIN t USING (item_key)"))
def q_split_group_repeated(spark, sf_dir):
    return S.repeated_split(expenses(spark, sf_dir).select(*KEYS), n_splits=5).select("split_id", "row_id", "split")


@register("split_stratified_group", f"""
WITH c AS ({O.clean('D')}),
v AS (SELECT item_key, account_name, count(*) AS n FROM c GROUP BY ALL),
d AS (SELECT item_key, min(account_name) FILTER (n = most) AS dom, max(most) AS most, sum(vec) AS vec
      FROM (SELECT *, max(n) OVER (PARTITION BY item_key) AS most,
            {O.hex7(O.md5_key(42, 'account_name', 'n'))} AS vec FROM v) w GROUP BY item_key),
f AS (SELECT item_key, CAST((row_number() OVER (ORDER BY dom, most DESC, vec, {O.md5_key(42, 'item_key')})
      - 1) % 3 AS INTEGER) AS fold FROM d)
SELECT c.row_id, f.fold FROM c JOIN f USING (item_key)""")
def q_split_stratified_group(spark, sf_dir):
    return S.stratified_group_folds(expenses(spark, sf_dir).select(*KEYS)).select("row_id", "fold")


def balanced_sql(seed: int, k: int = 3, min_train: int = 5, src: str = "c") -> str:
    """CTE chain ending in ``bs{seed}`` = (row_id, account_name, item_key, split)."""
    s = seed
    return f"""
g{s} AS (SELECT account_name, item_key, count(*) AS sz,
         md5('{s}:' || account_name || ':' || item_key) AS gh FROM {src} GROUP BY 1, 2),
lab{s} AS (SELECT account_name, sum(sz) AS total, count(*) AS ngroups FROM g{s} GROUP BY 1),
cum{s} AS (SELECT *, sum(sz) OVER (PARTITION BY account_name ORDER BY gh
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM g{s}),
pre{s} AS (SELECT * FROM cum{s} WHERE cum - sz < {k}),
tk{s} AS (SELECT account_name, count(*) AS nsel, max(cum) AS reach FROM pre{s} GROUP BY 1),
el{s} AS (SELECT l.account_name FROM lab{s} l JOIN tk{s} t USING (account_name)
          WHERE l.total - {k} >= {min_train} AND t.reach >= {k} AND t.nsel < l.ngroups),
sel{s} AS (SELECT account_name, item_key FROM pre{s} WHERE account_name IN (SELECT account_name FROM el{s})),
cand{s} AS (SELECT {src}.row_id, {src}.account_name, row_number() OVER (PARTITION BY {src}.account_name
            ORDER BY md5('{s}:' || CAST({src}.row_id AS VARCHAR))) AS rn
            FROM {src} JOIN sel{s} USING (account_name, item_key)),
bs{s} AS (SELECT {src}.*,
          CASE WHEN t.row_id IS NOT NULL THEN 'test' WHEN x.account_name IS NOT NULL THEN 'dropped'
               ELSE 'train' END AS split
          FROM {src} LEFT JOIN sel{s} x USING (account_name, item_key)
          LEFT JOIN (SELECT row_id FROM cand{s} WHERE rn <= {k}) t ON t.row_id = {src}.row_id)"""


@register("split_balanced_unseen", f"WITH c AS ({O.clean('D')}), {balanced_sql(42)} "
          "SELECT row_id, account_name, split FROM bs42")
def q_split_balanced_unseen(spark, sf_dir):
    return S.balanced_unseen_split(expenses(spark, sf_dir).select(*KEYS)).select("row_id", "account_name", "split")


@register("split_balanced_repeated", f"WITH c AS ({O.clean('D')}), "
          + ", ".join(balanced_sql(42 + r) for r in range(5)) + " "
          + " UNION ALL ".join(f"SELECT {r} AS repeat, row_id, split FROM bs{42 + r}" for r in range(5)))
def q_split_balanced_repeated(spark, sf_dir):
    return S.balanced_repeated_split(expenses(spark, sf_dir).select(*KEYS), repeats=5).select(
        "repeat", "row_id", "split")


@register("split_disjointness", f"""WITH c AS ({O.clean('D')}), {balanced_sql(42)},
te AS (SELECT DISTINCT account_name, item_key FROM bs42 WHERE split = 'test'),
tr AS (SELECT DISTINCT account_name, item_key FROM bs42 WHERE split = 'train'),
sup AS (SELECT account_name, count(*) AS n FROM bs42 WHERE split = 'test' GROUP BY 1)
SELECT (SELECT count(*) FROM te) AS test_pairs, (SELECT count(*) FROM tr) AS train_pairs,
       (SELECT count(*) FROM (SELECT * FROM te INTERSECT SELECT * FROM tr) i) AS shared_pairs,
       (SELECT count(*) FROM sup) AS eligible_labels,
       (SELECT min(n) FROM sup) AS min_test_support, (SELECT max(n) FROM sup) AS max_test_support""")
def q_split_disjointness(spark, sf_dir):
    s = S.balanced_unseen_split(expenses(spark, sf_dir).select(*KEYS))
    pairs = ["account_name", "item_key"]
    te = s.where("split = 'test'").select(*pairs).distinct()
    tr = s.where("split = 'train'").select(*pairs).distinct()
    sup = s.where("split = 'test'").groupBy("account_name").agg(F.count(F.lit(1)).alias("n"))
    stats = [te.count(), tr.count(), te.intersect(tr).count()]
    return sup.agg(F.count(F.lit(1)).alias("eligible_labels"),
                   F.min("n").alias("min_test_support"), F.max("n").alias("max_test_support")
                   ).select(F.lit(stats[0]).cast("bigint").alias("test_pairs"),
                            F.lit(stats[1]).cast("bigint").alias("train_pairs"),
                            F.lit(stats[2]).cast("bigint").alias("shared_pairs"), "*")


@register("oversample_minority", f"""WITH s AS ({O.with_group_split('D')}),
tr AS (SELECT * FROM s WHERE split = 'train'),
m AS (SELECT account_name, count(*) AS n FROM tr GROUP BY 1 HAVING count(*) < 10),
rk AS (SELECT tr.row_id, tr.account_name, row_number() OVER (PARTITION BY tr.account_name
       ORDER BY {O.md5_key(42, 'row_id')}, tr.row_id) AS r FROM tr JOIN m USING (account_name)),
cp AS (SELECT account_name, CAST(i AS INTEGER) AS copy_no,
       1 + {O.hex7("md5('42:' || account_name || ':' || CAST(i AS VARCHAR))")} % n AS r
       FROM (SELECT account_name, n, unnest(generate_series(1, 10 - n)) AS i FROM m) e)
SELECT row_id, account_name, 0 AS copy_no FROM tr
UNION ALL SELECT rk.row_id, rk.account_name, cp.copy_no FROM cp JOIN rk USING (account_name, r)""")
def q_oversample_minority(spark, sf_dir):
    train = S.group_split(expenses(spark, sf_dir)).where("split = 'train'")
    return S.oversample_minority(train, min_count=10).select("row_id", "account_name", "copy_no")


@register("learning_curve_prefix", _GROUP_REPEATED_SQL.replace("range(5)", "range(3)") + """,
tr AS (SELECT t.split_id, c.row_id, row_number() OVER (PARTITION BY t.split_id
       ORDER BY md5('42:' || CAST(c.row_id AS VARCHAR))) AS rk,
       count(*) OVER (PARTITION BY t.split_id) AS n FROM c JOIN t USING (item_key) WHERE NOT is_test)
SELECT split_id, f AS train_fraction, row_id FROM tr,
       (SELECT unnest([0.2::DOUBLE, 0.4::DOUBLE, 0.6::DOUBLE, 0.8::DOUBLE, 1.0::DOUBLE]) AS f) fr
WHERE rk <= floor(f * n)""")
def q_learning_curve_prefix(spark, sf_dir):
    splits = S.repeated_split(expenses(spark, sf_dir).select(*KEYS), n_splits=3).where("split = 'train'")
    return S.learning_prefixes(splits).select("split_id", "train_fraction", "row_id")


# ---------------------------------------------------------------- metrics over lookup predictions

def _group_baseline(spark, sf_dir):
    pred, train = _baseline(spark, sf_dir, split="group")
    return pred, train


_GROUP_PRED = O.lookup_predictions(O.with_group_split("D"))


@register("classification_report", _GROUP_PRED + ", " + O.report("p") + (
    "SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, "
    "round(f1, 6) AS f1, support FROM rep"))
def q_classification_report(spark, sf_dir):
    pred, _ = _group_baseline(spark, sf_dir)
    rep = M.classification_report(pred)
    return rep.select("label", r6("precision").alias("precision"), r6("recall").alias("recall"),
                      r6("f1").alias("f1"), "support")


_AVG_COLS = ["macro_precision", "macro_recall", "macro_f1", "weighted_precision",
             "weighted_recall", "weighted_f1"]


@register("report_averages", _GROUP_PRED + ", " + O.report("p") + (
    "SELECT round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, "
    "round(avg(f1), 6) AS macro_f1, "
    "round(sum(precision * support) / sum(support), 6) AS weighted_precision, "
    "round(sum(recall * support) / sum(support), 6) AS weighted_recall, "
    "round(sum(f1 * support) / sum(support), 6) AS weighted_f1, count(*) AS n_labels FROM rep"))
def q_report_averages(spark, sf_dir):
    pred, _ = _group_baseline(spark, sf_dir)
    avg = M.report_averages(M.classification_report(pred))
    return avg.select(*[r6(c).alias(c) for c in _AVG_COLS], "n_labels")


def _ranked_sql(best: bool) -> str:
    order = "f1 DESC" if best else "f1 ASC"
    return _GROUP_PRED + ", " + O.report("p") + (
        f"SELECT label, round(f1, 6) AS f1, support, row_number() OVER (ORDER BY {order}, support DESC, "
        f"label) AS rank FROM rep WHERE support >= 5 ORDER BY {order}, support DESC, label LIMIT 10")


def _ranked_spark(spark, sf_dir, best: bool):
    pred, _ = _group_baseline(spark, sf_dir)
    top = M.ranked_labels(M.classification_report(pred), best=best)
    order = [F.col("f1").desc() if best else F.col("f1").asc(), F.col("support").desc(),
             F.col("label").asc()]
    from pyspark.sql import Window
    return top.select("label", r6("f1").alias("f1"), "support",
                      F.row_number().over(Window.orderBy(*order)).cast("bigint").alias("rank"))


@register("top_labels", _ranked_sql(True))
def q_top_labels(spark, sf_dir):
    return _ranked_spark(spark, sf_dir, True)


@register("bottom_labels", _ranked_sql(False))
def q_bottom_labels(spark, sf_dir):
    return _ranked_spark(spark, sf_dir, False)


@register("error_by_frequency", _GROUP_PRED + (
    ", cnt AS (SELECT account_name, count(*) AS n FROM tr GROUP BY 1), "
    "b AS (SELECT p.account_name, p.predicted, CASE WHEN coalesce(cnt.n, 0) = 1 THEN 'singleton (n=1)' "
    "WHEN coalesce(cnt.n, 0) BETWEEN 2 AND 4 THEN 'very_rare (2-4)' "
    "WHEN coalesce(cnt.n, 0) BETWEEN 5 AND 19 THEN 'rare (5-19)' "
    "WHEN coalesce(cnt.n, 0) BETWEEN 20 AND 99 THEN 'medium (20-99)' "
    "WHEN coalesce(cnt.n, 0) >= 100 THEN 'frequent (100+)' END AS bucket "
    "FROM p LEFT JOIN cnt USING (account_name)) "
    "SELECT bucket, CAST(sum(CAST(account_name = predicted AS INTEGER)) AS BIGINT) AS correct, "
    "count(*) AS total, round(sum(CAST(account_name = predicted AS INTEGER)) / count(*), 4) AS accuracy "
    "FROM b WHERE bucket IS NOT NULL GROUP BY 1"))
def q_error_by_frequency(spark, sf_dir):
    pred, train = _group_baseline(spark, sf_dir)
    return M.error_by_frequency(pred, train)


def _split_majority_sql(key: str, out: str) -> str:
    return (f"SELECT split_id, {key}, {out} FROM (SELECT split_id, {key}, account_name AS {out}, "
            f"row_number() OVER (PARTITION BY split_id, {key} ORDER BY n DESC, account_name) AS rn "
            f"FROM (SELECT split_id, {key}, account_name, count(*) AS n FROM tr GROUP BY ALL) v) r "
            f"WHERE rn = 1")


_REPEATED_EVAL_SQL = _GROUP_REPEATED_SQL + f""",
s AS (SELECT t.split_id, t.is_test, c.* FROM c JOIN t USING (item_key)),
tr AS (SELECT * FROM s WHERE NOT is_test), te AS (SELECT * FROM s WHERE is_test),
im AS ({_split_majority_sql('item_key', 'item_label')}),
vm AS ({_split_majority_sql('vendor_id', 'vendor_label')}),
gm AS (SELECT split_id, g FROM (SELECT split_id, account_name AS g, row_number() OVER
       (PARTITION BY split_id ORDER BY count(*) DESC, account_name) AS rn FROM tr GROUP BY 1, 2) r WHERE rn = 1),
p AS (SELECT te.split_id, te.account_name, coalesce(nullif(im.item_label, ''),
      nullif(vm.vendor_label, ''), gm.g) AS predicted FROM te LEFT JOIN im USING (split_id, item_key)
      LEFT JOIN vm USING (split_id, vendor_id) LEFT JOIN gm USING (split_id)),
{O.report('p', 'split_id')},
f AS (SELECT split_id, avg(f1) AS macro_f1 FROM rep GROUP BY 1),
a AS (SELECT split_id, avg(CAST(account_name = predicted AS DOUBLE)) AS acc FROM p GROUP BY 1)
"""


@register("repeated_baseline_stats", _REPEATED_EVAL_SQL + """
SELECT round(avg(acc), 6) AS accuracy_mean, round(stddev_pop(acc), 6) AS accuracy_std,
       round(avg(macro_f1), 6) AS macro_f1_mean, round(stddev_pop(macro_f1), 6) AS macro_f1_std,
       count(*) AS n_splits FROM a JOIN f USING (split_id)""")
def q_repeated_baseline_stats(spark, sf_dir):
    s = S.repeated_split(expenses(spark, sf_dir).select(*KEYS), n_splits=5)
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    pred = LK.lookup_predict(train, test, by="split_id")
    f1 = M.report_averages(M.classification_report(pred, by=["split_id"]), by=["split_id"])
    acc = pred.groupBy("split_id").agg(
        F.avg((F.col("account_name") == F.col("predicted")).cast("double")).alias("acc"))
    per_split = acc.join(f1.select("split_id", "macro_f1"), "split_id")
    return per_split.agg(r6(F.avg("acc")).alias("accuracy_mean"),
                         r6(F.stddev_pop("acc")).alias("accuracy_std"),
                         r6(F.avg("macro_f1")).alias("macro_f1_mean"),
                         r6(F.stddev_pop("macro_f1")).alias("macro_f1_std"),
                         F.count(F.lit(1)).alias("n_splits"))


# ---------------------------------------------------------------- text features (TXT-1..10)

@register("word_tokens", f"WITH c AS ({O.clean('D')}) "
          + O.term_counts("c", O.word_terms("text", bigrams=False)))
def q_word_tokens(spark, sf_dir):
    from dataclasses import replace
    return TF.term_counts(expenses(spark, sf_dir), replace(TF.WORD, ngram_max=1))


@register("word_ngrams", f"WITH c AS ({O.clean('D')}) " + O.term_counts("c", O.word_terms("text")))
def q_word_ngrams(spark, sf_dir):
    return TF.term_counts(expenses(spark, sf_dir), TF.WORD)


@register("char_wb_ngrams", f"WITH c AS ({O.clean('D')}) " + O.term_counts("c", O.char_terms("text")))
def q_char_wb_ngrams(spark, sf_dir):
    return TF.term_counts(expenses(spark, sf_dir), TF.CHAR)


@register("doc_freq", f"WITH c AS ({O.clean('D')}), "
          + O.tfidf("c", "c", O.word_terms("text"), 2)
          + "SELECT term, df, round(idf, 6) AS idf FROM idf")
def q_doc_freq(spark, sf_dir):
    df = expenses(spark, sf_dir)
    return TF.fit_vocabulary(df, TF.WORD).select("term", "df", r6("idf").alias("idf"))


def _tfidf_sql(terms, min_df, train="c", apply="c", prefix=None):
    head = prefix or f"WITH c AS ({O.clean('D')}), "
    return (head + O.tfidf(train, apply, terms, min_df)
            + "SELECT row_id, term, round(weight, 6) AS weight FROM tw")


def _tfidf_spark(df, block, apply_to=None):
    return TF.tfidf(df, block, apply_to).select("row_id", "term", r6("weight").alias("weight"))


@register("tfidf_word", _tfidf_sql(O.word_terms("text"), 2))
def q_tfidf_word(spark, sf_dir):
    return _tfidf_spark(expenses(spark, sf_dir), TF.WORD)


@register("tfidf_item", _tfidf_sql(O.word_terms("item_key"), 1))
def q_tfidf_item(spark, sf_dir):
    return _tfidf_spark(expenses(spark, sf_dir), TF.ITEM)


@register("tfidf_char", _tfidf_sql(O.char_terms("text"), 1))
def q_tfidf_char(spark, sf_dir):
    return _tfidf_spark(expenses(spark, sf_dir), TF.CHAR)


@register("tfidf_transform", _tfidf_sql(
    O.word_terms("text"), 2, train="trn", apply="tst",
    prefix=f"WITH s AS ({O.with_group_split('D')}), trn AS (SELECT * FROM s WHERE split = 'train'), "
           f"tst AS (SELECT * FROM s WHERE split = 'test'), "))
def q_tfidf_transform(spark, sf_dir):
    s = S.group_split(expenses(spark, sf_dir))
    return _tfidf_spark(s.where("split = 'train'"), TF.WORD, s.where("split = 'test'"))


# ---------------------------------------------------------------- categorical / numeric (FEA-1..4)

@register("vendor_onehot", f"SELECT vendor_id, row_number() OVER (ORDER BY vendor_id) - 1 AS vendor_index "
          f"FROM (SELECT DISTINCT vendor_id FROM ({O.clean('L')}) c) v")
def q_vendor_onehot(spark, sf_dir):
    return FE.vendor_index(expenses(spark, sf_dir, "L"))


@register("amount_maxabs", f"WITH c AS ({O.clean('L')}) SELECT row_id, round(amount_log / "
          f"(SELECT CASE WHEN max(abs(amount_log)) = 0 THEN 1.0 ELSE max(abs(amount_log)) END FROM c), 6) "
          f"AS amount_scaled FROM c")
def q_amount_maxabs(spark, sf_dir):
    df = expenses(spark, sf_dir, "L")
    m = FE.max_abs(df)
    return df.select("row_id", r6(FE.scale_max_abs("amount_log", m)).alias("amount_scaled"))


_EDGES_SQL = (f"WITH c AS ({O.clean('D')}), q AS (SELECT list_sort(list_distinct(quantile_cont("
              f"amount_log, {O.QUANTILE_LIST}))) AS edges FROM c) ")


@register("amount_bin_edges", _EDGES_SQL + (
    "SELECT CAST(idx - 1 AS INTEGER) AS edge_index, round(edges[idx], 6) AS edge FROM q, "
    "(SELECT unnest(range(1, 12)) AS idx) r WHERE idx <= len(edges)"))
def q_amount_bin_edges(spark, sf_dir):
    edges = FE.bin_edges(expenses(spark, sf_dir))
    # At most 11 values computed by the distributed percentile job, returned as a frame.
    rows = [(i, round(e, 6)) for i, e in enumerate(edges)]
    return spark.createDataFrame(rows, "edge_index int, edge double")


@register("amount_bins", _EDGES_SQL + (
    "SELECT row_id, CAST(least(len(list_filter(edges[2:len(edges) - 1], lambda e: e <= amount_log)), "
    "greatest(len(edges) - 2, 0)) AS INTEGER) AS amount_bin FROM c, q"))
def q_amount_bins(spark, sf_dir):
    df = expenses(spark, sf_dir)
    edges = FE.bin_edges(df)
    return df.select("row_id", FE.bin_index("amount_log", edges).alias("amount_bin"))


@register("class_weights", f"WITH c AS ({O.clean('D')}), n AS (SELECT account_name, count(*) AS n "
          f"FROM c GROUP BY 1) SELECT account_name, n, round((SELECT sum(n) FROM n) / "
          f"((SELECT count(*) FROM n) * n), 6) AS weight FROM n")
def q_class_weights(spark, sf_dir):
    from spendlens.operators.train import balanced_class_weights
    return balanced_class_weights(expenses(spark, sf_dir)).select(
        "account_name", "n", r6("weight").alias("weight"))


# ---------------------------------------------------------------- confidence-gated fallback (JOI-2, MDL-5)

@register("vendor_fallback", O.lookup_predictions(O.with_random_split("D")).split(", p AS (")[0] + f""",
ic AS (SELECT item_key, max(n) / sum(n) AS conf FROM (SELECT item_key, account_name, count(*) AS n
       FROM tr GROUP BY ALL) v GROUP BY 1),
gc AS (SELECT max(n) / sum(n) AS conf FROM (SELECT account_name, count(*) AS n FROM tr GROUP BY 1) v),
q AS (SELECT te.row_id, te.vendor_id, coalesce(im.item_label, (SELECT g FROM gm)) AS model_pred,
      coalesce(ic.conf, (SELECT conf FROM gc)) AS max_prob
      FROM te LEFT JOIN im USING (item_key) LEFT JOIN ic USING (item_key))
SELECT row_id, CASE WHEN max_prob < 0.5 AND coalesce(vm.vendor_label, '') <> '' THEN vm.vendor_label
       ELSE model_pred END AS predicted,
       CASE WHEN max_prob < 0.5 AND coalesce(vm.vendor_label, '') <> '' THEN 'vendor_fallback'
       ELSE 'model' END AS source, round(max_prob, 6) AS max_prob
FROM q LEFT JOIN vm USING (vendor_id)""")
def q_vendor_fallback(spark, sf_dir):
    s = S.random_split(expenses(spark, sf_dir))
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    items = LK.majority_by(train, "item_key", out="item_label")
    g_label, g_votes, g_rows = LK.global_majority_by(
        train.withColumn("_all", F.lit(0)), "_all")[0]
    scored = (test.join(items, "item_key", "left")
              .select("row_id", "vendor_id",
                      F.coalesce(F.col("item_label"), F.lit(g_label)).alias("predicted"),
                      F.coalesce(F.col("item_label_votes") / F.col("item_key_rows"),
                                 F.lit(g_votes / g_rows)).alias("max_prob")))
    out = LK.apply_vendor_fallback(scored, LK.vendor_account_map(train), threshold=0.5)
    return out.select("row_id", "predicted", "source", r6("max_prob").alias("max_prob"))


# ---------------------------------------------------------------- sketches against the exact numbers

@register("sketch_items_per_label", f"""
WITH c AS ({O.clean('D')})
SELECT account_name, count(DISTINCT item_key) AS unique_items, true AS within FROM c GROUP BY account_name""")
def q_sketch_items_per_label(spark, sf_dir):
    """The distinct sketch of every label beside the exact count, and whether it lies within four
    standard errors of it."""
    df = expenses(spark, sf_dir).select("account_name", "item_key", "amount_log")
    guess = SK.estimates(SK.label_sketches(df), [0.5]).select("account_name", F.col("unique_items").alias("guess"))
    off = F.abs(F.col("guess") - F.col("unique_items"))
    return P.items_per_label(df).join(guess, "account_name").select(
        "account_name", "unique_items",
        (off <= F.greatest(F.lit(1.0), 4 * SK.DISTINCT_ERROR * F.col("unique_items"))).alias("within"))


@register("sketch_amount_deciles", f"""
WITH c AS ({O.clean('D')}), n AS (SELECT count(*) AS n FROM c)
SELECT CAST(d AS INTEGER) AS decile, n AS rows, true AS within FROM range(0, 11) r(d), n""")
def q_sketch_amount_deciles(spark, sf_dir):
    """Deciles of the label sketches put together, and whether the rank that each truly has is
    within twice the sketch's rank error."""
    df = expenses(spark, sf_dir).select("account_name", "item_key", "amount_log")
    wanted = [i / 10 for i in range(11)]
    got = SK.estimates(SK.merged(SK.label_sketches(df)), wanted).first()["quantiles"] or [None] * 11
    ranks = df.agg(F.count(F.lit(1)).alias("rows"), *[
        F.count_if(c).alias(f"{n}{i}") for i, q in enumerate(got)
        for n, c in (("below", F.col("amount_log") < q), ("upto", F.col("amount_log") <= q))])
    slack = 2 * SK.RANK_ERROR
    return ranks.select("rows", F.inline(F.array(*[
        F.struct(F.lit(i).alias("decile"),
                 ((F.col(f"below{i}") <= (f + slack) * F.col("rows"))
                  & (F.col(f"upto{i}") >= (f - slack) * F.col("rows"))).alias("within"))
        for i, f in enumerate(wanted)])))


# ---------------------------------------------------------------- models (MDL, EVA, TUN): rows-only

def _union_sql() -> str:
    """nnz and squared length of each test row's six blocks, vocabularies of the training rows."""
    def block(name, terms, min_df):
        x = O.tfidf("trn", "tst", terms, min_df)
        for cte in ("tctr", "tcap", "voc", "idf", "raw", "tw"):
            x = x.replace(f"{cte} AS (", f"{name}_{cte} AS (")
        for ref in ("tctr GROUP", "voc, ", "tcap JOIN", "raw) "):
            x = x.replace(f"FROM {ref}", f"FROM {name}_{ref}")
        return x.replace("JOIN idf USING", f"JOIN {name}_idf USING").rstrip()
    blocks = [block("w", O.word_terms("text"), 2), block("i", O.word_terms("item_key"), 1),
              block("c", O.char_terms("text"), 1)]
    tw = " UNION ALL ".join(f"SELECT row_id, weight FROM {n}_tw" for n in "wic")
    return (f"WITH s AS ({O.with_group_split('D')}), trn AS (SELECT * FROM s WHERE split = 'train'), "
            f"tst AS (SELECT * FROM s WHERE split = 'test'), " + ", ".join(blocks)
            + f", tx AS (SELECT row_id, count(*) AS n, sum(weight * weight) AS q FROM ({tw}) u GROUP BY 1), "
            "m AS (SELECT CASE WHEN max(abs(amount_log)) = 0 THEN 1.0 ELSE max(abs(amount_log)) END AS m FROM trn) "
            "SELECT tst.row_id, coalesce(tx.n, 0) + 1 + CAST(v.vendor_id IS NOT NULL AS INTEGER) "
            "+ CAST(amount_log <> 0 AS INTEGER) AS nnz, round(coalesce(tx.q, 0) + 1 "
            "+ CAST(v.vendor_id IS NOT NULL AS INTEGER) + power(amount_log / m.m, 2), 6) AS sum_sq "
            "FROM tst CROSS JOIN m LEFT JOIN tx USING (row_id) "
            "LEFT JOIN (SELECT DISTINCT vendor_id FROM trn) v USING (vendor_id)")


@register("feature_union", _union_sql())
def q_feature_union(spark, sf_dir):
    s = S.group_split(expenses(spark, sf_dir))
    ff = FE.fit_features(s.where("split = 'train'"))
    arr = FE.feature_arrays(ff, s.where("split = 'test'"), ["row_id"])
    return arr.select("row_id", F.size("idx").cast("bigint").alias("nnz"),
                      r6(F.aggregate("val", F.lit(0.0), lambda a, x: a + x * x)).alias("sum_sq"))


@register("train_score")
def q_train_score(spark, sf_dir):
    return EV.evaluate_holdout(expenses(spark, sf_dir), "group_item")["eval"]


@register("model_label_report")
def q_model_label_report(spark, sf_dir):
    return EV.evaluate_holdout(expenses(spark, sf_dir), "group_item")["report"]


@register("model_error_by_frequency")
def q_model_error_by_frequency(spark, sf_dir):
    return EV.evaluate_holdout(expenses(spark, sf_dir), "group_item")["errors"]


@register("eval_holdout")
def q_eval_holdout(spark, sf_dir):
    df = FE.term_store(expenses(spark, sf_dir))
    return EV.evaluate_holdout(df, "random")["eval"].unionByName(
        EV.evaluate_holdout(df, "group_item")["eval"])


@register("eval_repeated")
def q_eval_repeated(spark, sf_dir):
    return EV.evaluate_repeated(expenses(spark, sf_dir), "group_item", n_splits=5)


@register("eval_balanced")
def q_eval_balanced(spark, sf_dir):
    return EV.evaluate_balanced(expenses(spark, sf_dir))


@register("eval_balanced_repeated")
def q_eval_balanced_repeated(spark, sf_dir):
    return EV.evaluate_balanced_repeated(expenses(spark, sf_dir), repeats=5)


@register("calibrated_predict")
def q_calibrated_predict(spark, sf_dir):
    pred = EV.evaluate_calibrated(expenses(spark, sf_dir), "group_item")["pred"]
    return pred.select("row_id", "account_name", "predicted", "source", "max_prob")


@register("eval_calibrated")
def q_eval_calibrated(spark, sf_dir):
    df = FE.term_store(expenses(spark, sf_dir))
    return EV.evaluate_calibrated(df, "group_item")["eval"].unionByName(
        EV.evaluate_calibrated(df, "balanced")["eval"])


@register("learning_curve")
def q_learning_curve(spark, sf_dir):
    return EV.learning_curve(expenses(spark, sf_dir))


@register("validation_curve")
def q_validation_curve(spark, sf_dir):
    return EV.validation_curve(expenses(spark, sf_dir))


@register("diagnostics")
def q_diagnostics(spark, sf_dir):
    """Without the curves, which are queries of their own (``learning_curve``, ``validation_curve``)."""
    return SM.diagnostics(expenses(spark, sf_dir), curves=False)


_GRIDS: dict = {}


def _grid(spark, sf_dir, store=None):
    """The grid's 50 rows, fitted once a session for the same input files: selection, series
    and the second stage all start from it. ``store`` holds the input's counted terms, if
    there is one."""
    df = expenses(spark, sf_dir)
    key = (spark.sparkContext.applicationId, tuple(sorted(df.inputFiles())), df.count())
    if key not in _GRIDS:
        g = EV.tune_grid(df if store is None else store)
        _GRIDS.clear()
        _GRIDS[key] = (g.collect(), g.schema)
    return spark.createDataFrame(*_GRIDS[key])


@register("tune_grid")
def q_tune_grid(spark, sf_dir):
    return _grid(spark, sf_dir)


@register("tune_select")
def q_tune_select(spark, sf_dir):
    return EV.select_best(_grid(spark, sf_dir), "val_macro_f1_mean")


@register("tune_grid_series")
def q_tune_grid_series(spark, sf_dir):
    """TOP-7: grid series per (class_weight, oversample), points ordered by C."""
    return EV.grid_series(_grid(spark, sf_dir))


@register("tune_two_stage")
def q_tune_two_stage(spark, sf_dir):
    store = FE.term_store(expenses(spark, sf_dir))  # both stages read it
    return EV.tune_two_stage(store, grid=_grid(spark, sf_dir, store))["best"]


# ---------------------------------------------------------------- tracking tables (TRK-2/3/6/8/9)

def lookup_evals(spark, sf_dir) -> DataFrame:
    """EVAL table of the lookup model on the random, group and balanced splits."""
    df = expenses(spark, sf_dir).select(*KEYS)
    splits = {"random": S.random_split(df), "group_item": S.group_split(df),
              "balanced_holdout": S.balanced_unseen_split(df)}
    parts = []
    for key, s in splits.items():
        s = s
        pred = LK.lookup_predict(s.where("split = 'train'"), s.where("split = 'test'"))
        acc = pred.agg(F.avg((F.col("account_name") == F.col("predicted")).cast("double")).alias("accuracy"))
        f1 = M.report_averages(M.classification_report(pred)).select("macro_f1")
        row = acc.select("accuracy", F.lit(f1.first()["macro_f1"]).alias("macro_f1"))
        parts.append(row.select(F.lit(key).alias("key"), "accuracy", "macro_f1"))
        if key == "random":
            parts.append(row.select(F.lit("baseline").alias("key"), "accuracy", "macro_f1"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _lookup_evals_sql() -> str:
    chains = [O.lookup_eval(O.with_random_split("D"), "r_", "random"),
              O.lookup_eval(O.with_group_split("D"), "g_", "group_item"),
              O.lookup_eval(f"WITH c AS ({O.clean('D')}), {balanced_sql(42)} SELECT * FROM bs42",
                            "b_", "balanced_holdout")]
    return ("WITH " + ", ".join(chains) + ", evals AS (SELECT * FROM r_ev UNION ALL SELECT * FROM g_ev "
            "UNION ALL SELECT * FROM b_ev UNION ALL SELECT 'baseline' AS key, accuracy, macro_f1 FROM r_ev) ")


@register("metric_card", _lookup_evals_sql() + (
    "SELECT position, benchmark, round(accuracy, 6) AS accuracy, round(CASE WHEN key = 'baseline' "
    "THEN NULL ELSE macro_f1 END, 6) AS macro_f1 FROM (SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{n}', '{k}')" for i, (n, k) in enumerate(TK.METRIC_CARD))
    + ") v(position, benchmark, key)) card LEFT JOIN evals USING (key)"))
def q_metric_card(spark, sf_dir):
    card = TK.metric_card(lookup_evals(spark, sf_dir))
    return card.select(F.col("position").cast("int").alias("position"), "benchmark",
                       r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"))


@register("flat_metrics", _lookup_evals_sql() + (
    "SELECT key || '_accuracy' AS metric, round(accuracy, 6) AS value FROM evals WHERE accuracy IS NOT NULL "
    "UNION ALL SELECT key || '_macro_f1', round(macro_f1, 6) FROM evals WHERE macro_f1 IS NOT NULL"))
def q_flat_metrics(spark, sf_dir):
    flat = TK.flat_metrics(lookup_evals(spark, sf_dir))
    return flat.select("metric", r6("value").alias("value"))


@register("champion_metrics", _REPEATED_EVAL_SQL + """
SELECT 'lookup' AS model_name, 5 AS version, 'run-4' AS run_id, 'accuracy' AS metric, round(acc, 6) AS value
FROM a WHERE split_id = 4""")
def q_champion_metrics(spark, sf_dir):
    """Each of 5 repeated group splits is a run of the lookup model; all are logged and
    registered with one write each. The champion (latest version) and its run's metrics
    are returned."""
    from spendlens.session import scratch_path
    import uuid
    base = scratch_path(spark, f"registry-{uuid.uuid4().hex}")
    s = S.repeated_split(expenses(spark, sf_dir).select(*KEYS), n_splits=5)
    pred = LK.lookup_predict(s.where("split = 'train'"), s.where("split = 'test'"), by="split_id")
    run = F.concat(F.lit("run-"), F.col("split_id").cast("string")).alias("run_id")
    runs = pred.groupBy("split_id").agg(
        F.avg((F.col("account_name") == F.col("predicted")).cast("double")).alias("accuracy"))
    TK.log_run_metrics(runs.select(run, F.lit("accuracy").alias("metric"), F.col("accuracy").alias("value")),
                       f"{base}/run_metrics")
    logged = spark.read.parquet(f"{base}/run_metrics")
    TK.register_versions(logged.select("run_id", F.concat(F.lit("models/"), "run_id").alias("path")).distinct(),
                         f"{base}/model_versions", "lookup", "run_id")
    champion = TK.champion_metrics(spark.read.parquet(f"{base}/model_versions"), logged)
    return champion.select("model_name", "version", "run_id", "metric", r6("value").alias("value"))


@register("comparison_tables", _lookup_evals_sql() + (
    "SELECT 'holdout' AS key, round(b.accuracy, 6) AS accuracy_before, round(b.macro_f1, 6) AS macro_f1_before, "
    "round(a.accuracy, 6) AS accuracy_after, round(a.macro_f1, 6) AS macro_f1_after, "
    "round(a.accuracy - b.accuracy, 6) AS accuracy_delta, round(a.macro_f1 - b.macro_f1, 6) AS macro_f1_delta "
    "FROM evals b, evals a WHERE b.key = 'random' AND a.key = 'group_item'"))
def q_comparison_tables(spark, sf_dir):
    """Before/after: lookup model on the random vs the group split (leakage effect)."""
    ev = lookup_evals(spark, sf_dir)
    before = ev.where("key = 'random'").withColumn("key", F.lit("holdout"))
    after = ev.where("key = 'group_item'").withColumn("key", F.lit("holdout"))
    out = TK.comparison(before, after)
    return out.select("key", *[r6(c).alias(c) for c in out.columns if c != "key"])


# ---------------------------------------------------------------- a model's run, logged and promoted

_RUNS: dict = {}


def _model_run(spark, sf_dir):
    """Where the run's summary lies, its tuned config and its term store: tuned over the whole
    grid that ``tune_grid`` searches, evaluated and written once a session for the same input
    files, whose texts are tokenised once."""
    from spendlens.session import scratch_path
    import uuid
    df = expenses(spark, sf_dir)
    key = (spark.sparkContext.applicationId, tuple(sorted(df.inputFiles())), df.count())
    if key not in _RUNS:
        store = FE.term_store(df)
        best = EV.tune_two_stage(store, grid=_grid(spark, sf_dir, store))["best"].first()
        tuned = SM.config_of(best)
        path = scratch_path(spark, f"run-{uuid.uuid4().hex}")
        SM.write_summary(SM.run_evaluations(store, tuned), df, tuned, f"{path}/evaluation_summary")
        _RUNS.clear()
        _RUNS[key] = path, tuned, store
    return _RUNS[key]


@register("model_metric_card")
def q_model_metric_card(spark, sf_dir):
    """TRK-2 from the summary as written (SNK-3) and read back."""
    path = _model_run(spark, sf_dir)[0]
    return TK.metric_card(SM.read_summary(spark, f"{path}/evaluation_summary"))


@register("model_champion_metrics")
def q_model_champion_metrics(spark, sf_dir):
    """TRK-6/8: models of the default and of the tuned config, fitted on all rows and saved, are
    two versions; the later is the champion, and the six metrics of its run are looked up
    through the registry. ``classes`` is read from the model that the alias loads."""
    from spendlens.session import scratch_path
    import uuid
    from spendlens.sources import sinks as SN
    path, tuned, store = _model_run(spark, sf_dir)
    evals = SM.read_summary(spark, f"{path}/evaluation_summary")
    base = scratch_path(spark, f"registry-{uuid.uuid4().hex}")
    runs = (("default", SM.DEFAULT, evals.where("key IN ('baseline', 'random', 'group_item')")), ("tuned", tuned, evals))
    for run, config, own in runs:
        SN.save_model(TR.fit_model(store, **config), f"{base}/models/{run}")
        TK.log_metrics(TK.named_metrics(own), run, f"{base}/run_metrics")
        TK.register_version(spark, f"{base}/model_versions", "account_classifier", run, f"{base}/models/{run}")
    model = TK.load_by_alias(spark, f"{base}/model_versions", "account_classifier")[0]
    return TK.champion_metrics(spark.read.parquet(f"{base}/model_versions"), spark.read.parquet(f"{base}/run_metrics"),
                               TK.CHAMPION_METRICS).select("model_name", "version", "run_id", "metric", "value",
                                                           F.lit(len(model.labels)).alias("classes"))


# ---------------------------------------------------------------- sinks and stream (SNK, STR): rows-only

@register("export_splits", (
    f"SELECT 'run-1' AS run_id, 'group_item' AS split_name, split, count(*) AS rows "
    f"FROM ({O.with_group_split('D')}) s GROUP BY split"))
def q_export_splits(spark, sf_dir):
    from spendlens.session import scratch_path
    import uuid
    from spendlens.sources import sinks as SN
    path = scratch_path(spark, f"exports-{uuid.uuid4().hex}")
    df = expenses(spark, sf_dir)
    SN.export_csv(df, f"{path}/dataset")
    SN.export_splits(S.group_split(df), f"{path}/splits", "run-1", "group_item")
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(f"{path}/splits")
    return back.groupBy("run_id", "split_name", "split").agg(F.count(F.lit(1)).alias("rows"))


@register("fit_full_model")
def q_fit_full_model(spark, sf_dir):
    from spendlens.session import scratch_path
    import uuid
    from spendlens.sources import sinks as SN
    df = FE.term_store(expenses(spark, sf_dir))  # fitted and scored without tokenising again
    tm = TR.fit_model(df)
    path = scratch_path(spark, f"model-{uuid.uuid4().hex}")
    SN.save_model(tm, path, TR.fit_calibration(tm), LK.vendor_account_map(df))
    loaded = SN.load_model(spark, path)[0]
    return TR.score(loaded, df, keep=["row_id", "account_name"]).select("row_id", "account_name", "predicted")


@register("stream_score")
def q_stream_score(spark, sf_dir):
    from spendlens.session import scratch_path
    import uuid
    from spendlens.sources.raw import to_raw_json_rows
    from spendlens.streaming.score import start_scoring_stream
    base = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    s = S.group_split(expenses(spark, sf_dir))
    train = s.where("split = 'train'")
    tm = TR.fit_model(train)
    cal = TR.fit_calibration(tm)
    raw = raw_view(spark, sf_dir).join(s.where("split = 'test'").select("row_id"), "row_id")
    to_raw_json_rows(raw).repartition(4).write.mode("overwrite").json(f"{base}/incoming")
    q = start_scoring_stream(spark, tm, f"{base}/incoming", f"{base}/scored", f"{base}/checkpoint",
                             LK.vendor_account_map(train), cal)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/scored")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
