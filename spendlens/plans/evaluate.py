"""Evaluation plans (EVA-1..8, TUN-1/2, SPL-6, TOP-4/5, PRJ-11/12).

Every evaluation is: split (hash rule) -> fit (features + one-vs-rest SVMs, several configs
stacked when they share a training set) -> score -> metrics as aggregations keyed by
``cfg``. Independent fits (different splits or oversampling levels) are submitted from
driver threads so Spark runs their jobs concurrently. Results are small DataFrames.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.operators import features as FE
from spendlens.operators import lookup as LK
from spendlens.operators import metrics as M
from spendlens.operators import split as S
from spendlens.operators import train as TR
from spendlens.session import write_table

LABEL = "account_name"

# The reference's search spaces and thresholds.
GRID_C = [0.5, 1.0, 2.0, 4.0, 8.0]
GRID_CLASS_WEIGHT = [None, "balanced"]
GRID_OVERSAMPLE = [0, 5, 10, 15, 20]
VALIDATION_C = [0.1, 0.25, 0.5, 1.0, 2.0, 4.0, 8.0, 16.0]
MIN_GROUPED_ACCURACY = 0.85
UNDERFIT_BELOW = 0.60
OVERFIT_GAP_ABOVE = 0.05
CONFIDENCE_THRESHOLD = 0.5
PARALLEL_FITS = 3
WIDE_FIT = 8

EVAL_SCHEMA = ("strategy string, split_id int, cfg int, C double, class_weight string, "
               "oversample_min_count int, train_accuracy double, accuracy double, "
               "accuracy_gap double, weighted_f1 double, macro_f1 double, train_size bigint, "
               "test_size bigint, labels_in_test bigint")


def run_parallel(fn, items, workers: int = PARALLEL_FITS) -> list:
    """Submit independent Spark plans from driver threads (Spark schedules them together)."""
    items = list(items)
    if len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(workers, len(items))) as pool:
        return list(pool.map(fn, items))


def _cfg_lookup(tm: TR.TrainedModel, key: str, cast: str) -> F.Column:
    pairs = []
    for i, c in enumerate(tm.configs):
        v = c.get(key)
        pairs += [F.lit(i), F.lit(None if v is None else v).cast(cast)]
    return F.element_at(F.create_map(*pairs), F.col("cfg"))


def evaluation_rows(tm: TR.TrainedModel, test_pred: DataFrame, strategy: str,
                    split_id: int = 0) -> DataFrame:
    """EVAL rows, one per stacked config: train accuracy on the (oversampled) training rows,
    test accuracy, weighted/macro F1, sizes (training rows with their copies: all were
    fitted) and the number of labels in test."""
    avg = M.report_averages(M.classification_report(test_pred, by=["cfg"]), by=["cfg"])
    test = test_pred.groupBy("cfg").agg(
        F.avg((F.col(LABEL) == F.col("predicted")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("test_size"), F.count_distinct(LABEL).alias("labels_in_test"))
    out = test.join(TR.train_accuracy(tm), "cfg").join(avg.select("cfg", "macro_f1", "weighted_f1"), "cfg")
    return out.select(
        F.lit(strategy).alias("strategy"), F.lit(split_id).cast("int").alias("split_id"),
        F.col("cfg").cast("int").alias("cfg"), _cfg_lookup(tm, "C", "double").alias("C"),
        F.coalesce(_cfg_lookup(tm, "class_weight", "string"), F.lit("None")).alias("class_weight"),
        _cfg_lookup(tm, "oversample_min_count", "int").alias("oversample_min_count"),
        "train_accuracy", "accuracy", (F.col("train_accuracy") - F.col("accuracy")).alias("accuracy_gap"),
        "weighted_f1", "macro_f1", "train_size", "test_size", "labels_in_test")


def _fit_eval(train: DataFrame, test: DataFrame, configs: list[dict], omc: int, strategy: str,
              split_id: int = 0) -> tuple[TR.TrainedModel, DataFrame, DataFrame]:
    """Fit, score, evaluate: model, written test predictions, one EVAL row per config."""
    tm = TR.fit_models(train, configs, omc)
    pred = write_table(TR.score(tm, test), "predictions")
    rows = evaluation_rows(tm, pred, strategy, split_id)
    # One row per config: keep the values, drop the (deep) lineage before results of many
    # fits are unioned.
    out = train.sparkSession.createDataFrame(rows.collect(), rows.schema)
    tm.release()
    return tm, pred, out


def _split(df: DataFrame, strategy: str, seed: int = S.DEFAULT_SEED) -> DataFrame:
    if strategy == "random":
        return S.random_split(df, seed=seed)
    if strategy == "group_item":
        return S.group_split(df, seed=seed)
    raise ValueError(f"no split named {strategy!r}")


def _stored(df: DataFrame) -> DataFrame:
    return df if FE.STORED in df.columns else FE.term_store(df)


def _cut(split: DataFrame, name: str) -> DataFrame:
    """A split written once, unless its rows are a term store, which is not written again."""
    return split if FE.STORED in split.columns else write_table(split, name)


# ---------------------------------------------------------------- EVA-1 single holdout

def evaluate_holdout(df: DataFrame, strategy: str = "group_item", C: float = 1.0,
                     class_weight: str | None = None, oversample_min_count: int = 0) -> dict:
    """EVA-1: holdout evaluation -> {'eval', 'report', 'errors', 'top', 'bottom', 'pred'}."""
    s = _split(df, strategy)  # one fit counts every row's terms once: nothing is stored
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    tm, pred, rows = _fit_eval(train, test, [{"C": C, "class_weight": class_weight}],
                               oversample_min_count, strategy)
    report = M.classification_report(pred)
    return {"eval": rows, "report": report, "errors": M.error_by_frequency(pred, train),
            "top": M.ranked_labels(report, best=True), "bottom": M.ranked_labels(report, best=False),
            "pred": pred, "model": tm}


# ---------------------------------------------------------------- EVA-2 repeated splits

def _summarise(rows: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-10: mean and population std across splits."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_splits"),
        F.avg("train_accuracy").alias("train_accuracy_mean"),
        F.avg("accuracy").alias("accuracy_mean"), F.stddev_pop("accuracy").alias("accuracy_std"),
        (F.avg("train_accuracy") - F.avg("accuracy")).alias("accuracy_gap_mean"),
        F.avg("weighted_f1").alias("weighted_f1_mean"),
        F.avg("macro_f1").alias("macro_f1_mean"), F.stddev_pop("macro_f1").alias("macro_f1_std"))


def labelled_store(df: DataFrame, strategy: str, n_splits: int, seed: int = S.DEFAULT_SEED):
    """(store, names, counted): the written term store with one boolean column per split (true
    for its training rows), and each split's document frequencies, all from one aggregation.
    Split i of SPL-3 is the single split with seed + i: rows are labelled, not multiplied."""
    if strategy not in ("group_item", "random"):
        raise ValueError(f"no repeated split named {strategy!r}")
    store = _stored(df)
    names = [f"train_{i}" for i in range(n_splits)]
    labelled = store
    for i, name in enumerate(names):
        labelled = _split(labelled, strategy, seed + i).withColumn(name, F.col("split") == "train").drop("split")
    frequencies: list = []  # made where they are asked for

    def counted(i):
        if not frequencies:
            frequencies.append(write_table(FE.document_frequencies(labelled, names), "document-frequencies"))
        return frequencies[0].select("b", "key", F.get("df", F.lit(i)).alias("df"))
    return labelled, names, counted


def repeated_rows(df: DataFrame, strategy: str = "group_item", n_splits: int = 5,
                  configs: list[dict] | None = None, oversample_min_count: int = 0,
                  seed: int = S.DEFAULT_SEED) -> DataFrame:
    configs = configs or [{"C": 1.0, "class_weight": None}]
    store, names, _ = labelled_store(df, strategy, n_splits, seed)

    def one(i):
        in_train = F.col(names[i])
        return _fit_eval(store.where(in_train).drop(*names), store.where(~in_train).drop(*names), configs,
                         oversample_min_count, strategy, i)[2]

    # Fits of many configs keep gradients of many columns at the driver: one at a time.
    parts = run_parallel(one, range(n_splits), PARALLEL_FITS if len(configs) < WIDE_FIT else 1)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def evaluate_repeated(df: DataFrame, strategy: str = "group_item", n_splits: int = 5,
                      C: float = 1.0, class_weight: str | None = None,
                      oversample_min_count: int = 0) -> DataFrame:
    """EVA-2: ``n_splits`` independent splits -> mean/std summary (one row)."""
    rows = repeated_rows(df, strategy, n_splits, [{"C": C, "class_weight": class_weight}],
                         oversample_min_count)
    return _summarise(rows, ["strategy", "C", "class_weight", "oversample_min_count"])


# ---------------------------------------------------------------- EVA-3 balanced holdout

def evaluate_balanced(df: DataFrame, C: float = 1.0, class_weight: str | None = None,
                      oversample_min_count: int = 0, seed: int = S.DEFAULT_SEED,
                      configs: list[dict] | None = None) -> DataFrame:
    """EVA-3: balanced unseen holdout; EVAL columns plus eligible labels and the min/max
    test support per label (class-balance check)."""
    configs = configs or [{"C": C, "class_weight": class_weight}]
    s = _cut(S.balanced_unseen_split(df, seed=seed), "balanced")
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    _, _, rows = _fit_eval(train, test, configs, oversample_min_count, "balanced_unseen")
    support = test.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("eligible_labels"), F.min("n").alias("min_test_support"),
        F.max("n").alias("max_test_support")).first()
    return rows.select("*", *[F.lit(v).cast("bigint").alias(k) for k, v in support.asDict().items()])


def evaluate_balanced_repeated(df: DataFrame, repeats: int = 5, C: float = 1.0,
                               class_weight: str | None = None, oversample_min_count: int = 0,
                               seed: int = S.DEFAULT_SEED) -> DataFrame:
    """SPL-6 / EVA-3 repeated: seeds seed..seed+repeats-1; the tuned config and the same
    config with balanced class weights share each training set (one stacked fit; an
    identical pair is trained once)."""
    configs = [{"C": C, "class_weight": class_weight}]
    if class_weight != "balanced":
        configs.append({"C": C, "class_weight": "balanced"})
    store = _stored(df)

    def one(r):
        return evaluate_balanced(store, oversample_min_count=oversample_min_count, seed=seed + r,
                                 configs=configs).withColumn("split_id", F.lit(r))

    parts = run_parallel(one, range(repeats))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return _summarise(rows, ["strategy", "C", "class_weight", "oversample_min_count"]).join(
        rows.groupBy("class_weight").agg(F.avg("eligible_labels").alias("eligible_labels_mean")),
        "class_weight")


# ---------------------------------------------------------------- EVA-5 calibrated fallback

def evaluate_calibrated(df: DataFrame, split: str = "group_item", C: float = 1.0,
                        class_weight: str | None = None, oversample_min_count: int = 0,
                        threshold: float = CONFIDENCE_THRESHOLD) -> dict:
    """EVA-5: fit on train (after oversampling), calibrate per-class sigmoids on the same
    (oversampled) training rows, vendor map from them too, then confidence-gated
    prediction on test. Returns {'eval': one row, 'pred': predictions}."""
    s = _cut(S.balanced_unseen_split(df) if split == "balanced" else S.group_split(df), "calibrated")
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    tm = TR.fit_model(train, C, class_weight, oversample_min_count)
    cal = TR.fit_calibration(tm)
    scored = TR.score(tm, test, calibration=cal)
    oversampled = (S.oversample_minority(train, oversample_min_count)
                   if oversample_min_count > 0 else train)
    pred = write_table(LK.apply_vendor_fallback(scored, LK.vendor_account_map(oversampled), threshold), "gated")
    tm.release()
    avg = M.report_averages(M.classification_report(pred)).first()
    acc = pred.agg(F.avg((F.col(LABEL) == F.col("predicted")).cast("double")).alias("a"),
                   F.count_if(F.col("source") == "vendor_fallback").alias("fallbacks"),
                   F.count(F.lit(1)).alias("n")).first()
    strategy = "calibrated_fallback_balanced" if split == "balanced" else "calibrated_fallback"
    spark = df.sparkSession
    row = spark.createDataFrame(
        [(strategy, float(threshold), float(C), str(class_weight), int(oversample_min_count),
          acc["a"], avg["weighted_f1"], avg["macro_f1"], int(acc["fallbacks"]), int(acc["n"]))],
        "strategy string, confidence_threshold double, C double, class_weight string, "
        "oversample_min_count int, accuracy double, weighted_f1 double, macro_f1 double, "
        "fallbacks bigint, test_size bigint")
    return {"eval": row, "pred": pred, "model": tm, "calibration": cal}


# ---------------------------------------------------------------- EVA-6/7/8 diagnostics

def learning_curve(df: DataFrame, C: float = 1.0, class_weight: str | None = None,
                   n_splits: int = 3) -> DataFrame:
    """EVA-6: 5 training-size prefixes x 3 group splits, no oversampling; mean train and
    validation accuracy per fraction. Each prefix is fitted whole: ``train_size`` is its rows."""
    store = _stored(df)
    splits = [_split(store, "group_item", S.DEFAULT_SEED + i) for i in range(n_splits)]
    prefixes = [S.learning_prefixes(s.where("split = 'train'").withColumn("split_id", F.lit(i)))
                for i, s in enumerate(splits)]
    jobs = [(i, f) for i in range(n_splits) for f in S.LEARNING_FRACTIONS]

    def one(job):
        i, f = job
        train = prefixes[i].where(F.col("train_fraction") == f).drop("split_id", "train_fraction", "split")
        test = splits[i].where("split = 'test'")
        _, _, rows = _fit_eval(train, test, [{"C": C, "class_weight": class_weight}], 0,
                               "learning_curve", i)
        return rows.withColumn("train_fraction", F.lit(f))

    parts = run_parallel(one, jobs)
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.groupBy("train_fraction").agg(
        F.avg("train_size").alias("train_size"), F.avg("train_accuracy").alias("train_accuracy"),
        F.avg("accuracy").alias("validation_accuracy"))


def validation_curve(df: DataFrame, class_weight: str | None = None, n_splits: int = 3,
                     c_values=VALIDATION_C) -> DataFrame:
    """EVA-7: accuracy over C (all C values stacked in one fit per split)."""
    configs = [{"C": c, "class_weight": class_weight} for c in c_values]
    rows = repeated_rows(df, "group_item", n_splits, configs)
    return rows.groupBy("C").agg(F.avg("train_accuracy").alias("train_accuracy"),
                                 F.avg("accuracy").alias("validation_accuracy"))


def stratified_group_cv(df: DataFrame, C: float = 1.0, class_weight: str | None = None,
                        oversample_min_count: int = 0, n_folds: int = 3) -> DataFrame:
    """SPL-4 cross-validation: each fold is the test set once."""
    folds = write_table(S.stratified_group_folds(_stored(df), n_folds), "folds")

    def one(i):
        return _fit_eval(folds.where(F.col("fold") != i).drop("fold"),
                         folds.where(F.col("fold") == i).drop("fold"),
                         [{"C": C, "class_weight": class_weight}], oversample_min_count,
                         "stratified_group_kfold", i)[2]

    parts = run_parallel(one, range(n_folds))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows.agg(F.avg("accuracy").alias("accuracy_mean"),
                    F.stddev_pop("accuracy").alias("accuracy_std"), F.count(F.lit(1)).alias("folds"))


def fit_assessment(eval_row: DataFrame) -> DataFrame:
    """PRJ-12: underfit if validation accuracy < 0.60, overfit if the gap > 0.05."""
    return eval_row.select(
        "train_accuracy", F.col("accuracy").alias("grouped_val_accuracy"),
        F.col("accuracy_gap").alias("gap"),
        (F.col("accuracy") < UNDERFIT_BELOW).alias("underfitting"),
        (F.col("accuracy_gap") > OVERFIT_GAP_ABOVE).alias("overfitting"))


# ---------------------------------------------------------------- TUN-1/2 tuning

def tune_grid(df: DataFrame, c_values=GRID_C, class_weights=GRID_CLASS_WEIGHT,
              oversample_values=GRID_OVERSAMPLE, n_splits: int = 5) -> DataFrame:
    """TUN-1: grid over (oversample, class_weight, C) on ``n_splits`` group splits. One fit per
    split trains all configs together (copies are row weights, so its features serve them
    all). Output: one row per config with grid position ``grid_pos``."""
    configs = [{"C": c, "class_weight": w, "oversample_min_count": o}
               for o in oversample_values for w in class_weights for c in c_values]
    rows = repeated_rows(df, "group_item", n_splits, configs)
    pos = {(omc, str(w), float(c)): n for n, (omc, w, c) in enumerate(
        (o, w, c) for o in oversample_values for w in class_weights for c in c_values)}
    pairs = []
    for (omc, w, c), n in pos.items():
        pairs += [F.lit(f"{omc}|{w}|{c}"), F.lit(n)]
    key = F.concat_ws("|", F.col("oversample_min_count").cast("string"), F.col("class_weight"),
                      F.col("C").cast("string"))
    grid = rows.groupBy("C", "class_weight", "oversample_min_count").agg(
        F.avg("accuracy").alias("val_accuracy_mean"), F.stddev_pop("accuracy").alias("val_accuracy_std"),
        F.avg("macro_f1").alias("val_macro_f1_mean"), F.stddev_pop("macro_f1").alias("val_macro_f1_std"),
        F.avg("train_accuracy").alias("train_accuracy_mean"))
    return grid.withColumn("gap_mean", F.round(F.col("train_accuracy_mean") - F.col("val_accuracy_mean"), 4)) \
               .withColumn("grid_pos", F.element_at(F.create_map(*pairs), key))


def select_best(grid: DataFrame, metric: str = "val_macro_f1_mean") -> DataFrame:
    """TOP-4: argmax of ``metric``; the first config in grid order wins ties (top-1 report)."""
    return grid.orderBy(F.col(metric).desc(), F.col("grid_pos").asc()).limit(1)


def grid_series(grid: DataFrame) -> DataFrame:
    """TOP-7: one series per (class_weight, oversample_min_count) with its points sorted by C
    (each series has one point per C value: a bounded group)."""
    point = F.struct("C", "val_accuracy_mean", "val_macro_f1_mean", "train_accuracy_mean")
    return (grid.groupBy("class_weight", "oversample_min_count")
            .agg(F.array_sort(F.collect_list(point)).alias("points"))
            .orderBy("oversample_min_count", "class_weight"))


def viable_configs(grid: DataFrame, floor: float = MIN_GROUPED_ACCURACY) -> DataFrame:
    """PRJ-11: configs with val_accuracy_mean >= floor, or all of them when none passes."""
    best = grid.agg(F.max("val_accuracy_mean")).first()[0]
    return grid if best is None or best < floor else grid.where(F.col("val_accuracy_mean") >= floor)


def tune_two_stage(df: DataFrame, floor: float = MIN_GROUPED_ACCURACY, grid: DataFrame | None = None) -> dict:
    """TUN-2: grouped grid -> accuracy floor (fallback: all) -> balanced holdout macro F1 of
    each viable config (one fit for all) -> strict argmax in grid order."""
    df = _stored(df)
    grid = grid if grid is not None else tune_grid(df)
    viable = viable_configs(grid, floor).collect()
    configs = [{"C": r["C"], "class_weight": None if r["class_weight"] == "None" else r["class_weight"],
                "oversample_min_count": r["oversample_min_count"]} for r in viable]
    rows = evaluate_balanced(df, configs=configs)
    scored = rows.select("C", "class_weight", "oversample_min_count",
                         F.col("accuracy").alias("balanced_accuracy"),
                         F.col("macro_f1").alias("balanced_macro_f1")).join(
        grid, ["C", "class_weight", "oversample_min_count"])
    best = scored.orderBy(F.col("balanced_macro_f1").desc(), F.col("grid_pos").asc()).limit(1)
    return {"grid": grid, "stage2": scored, "best": best}
