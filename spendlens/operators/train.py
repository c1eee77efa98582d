"""Model training, scoring and calibration (MDL-1..7, AGG-12).

The classifier is a one-vs-rest linear SVM (squared hinge, L2, cost C, ``balanced`` class
weights on the positive side of each binary problem) over the six-block features: see
``spendlens.operators.svm``. The training rows are dealt out by feature (``spendlens.operators.parts``),
and all (C, class_weight, oversampling) configs that share a training set share them.

Scoring deals out the rows in the same way, and every input row comes out once.
"""

from __future__ import annotations

import gc
import tempfile
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from spendlens.operators import features as FE
from spendlens.operators import parts as PT
from spendlens.operators import svm
from spendlens.operators.split import oversample_minority
from spendlens.session import write_table

LABEL = "account_name"
HELD_BYTES = 128 << 20  # beyond it the driver keeps a fit's result in a file


def _list_arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Each list as an array, a view of the column's values."""
    whole = column.combine_chunks()
    ends = np.cumsum(whole.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(whole.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(ends) else []


def balanced_class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """MDL-2: ``balanced`` weight per label = n_rows / (n_labels * rows_of_label)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("t"), F.count(F.lit(1)).alias("k")).first()
    return counts.withColumn("weight", F.lit(float(tot["t"])) / (F.lit(tot["k"]) * F.col("n")))


def row_weights(train: DataFrame, levels: list[int], label: str = LABEL) -> DataFrame:
    """(row_id, w): how often a row counts at each oversampling level, for the rows that are
    copied at some level. Only rows of minority labels are."""
    slim = train.select("row_id", label)
    copies = None
    for i, level in enumerate(levels):
        if level > 0:
            own = oversample_minority(slim, level, label=label).where("copy_no > 0").select("row_id", F.lit(i).alias("i"))
            copies = own if copies is None else copies.unionByName(own)
    if copies is None:
        return slim.limit(0).select("row_id", F.array().cast("array<double>").alias("w"))
    counts = [F.count_if(F.col("i") == i).cast("double") + 1 for i in range(len(levels))]
    return copies.groupBy("row_id").agg(F.array(*counts).alias("w"))


@dataclass
class TrainedModel:
    """The training rows by feature, and how much of each row a class of a config is made of."""
    features: FE.FittedFeatures
    labels: list
    matrix: PT.Matrix
    duals: np.ndarray                          # (distinct configs, classes, rows)
    place: list                                # of each config among the distinct ones
    configs: list = field(default_factory=list)
    gaps: list = field(default_factory=list)   # worst bound of the relative loss gap per config
    settled: list = field(default_factory=list)
    y: np.ndarray | None = None                # label number of every row
    w: np.ndarray | None = None                # (rows, levels): how often it counts
    right: np.ndarray | None = None            # (distinct configs, rows): whether it is predicted right
    first: np.ndarray | None = None            # (rows, classes): margins of the first config
    levels: list = field(default_factory=list)
    session: SparkSession | None = None

    @property
    def coefficients(self) -> np.ndarray:
        """(rows, configs, classes)"""
        return self.duals[self.place].transpose(2, 0, 1)

    @property
    def converged(self) -> list[bool]:
        return list(self.settled)

    def level_of(self, cfg: int) -> int:
        return self.levels.index(self.configs[cfg].get("oversample_min_count", 0))

    def release(self) -> None:
        """Let the rows by feature go, which the executors' disks keep."""
        self.matrix.release()


def held_numbers(shape: tuple) -> np.ndarray:
    """Zeros, in a file of the driver if they are many."""
    if int(np.prod(shape)) * 4 <= HELD_BYTES:
        return np.zeros(shape, np.float32)
    with tempfile.TemporaryFile() as file:
        return np.memmap(file, np.float32, "w+", shape=shape)


def _numbered(chunks: list, weights: list, levels: int) -> tuple[dict, np.ndarray, np.ndarray]:
    """Row numbers of each chunk, label numbers, and weights: (chunk, hashes of row ids, label
    numbers) are numbered in the order of hash and label, wherever a row was read."""
    ids, y = (np.concatenate([np.zeros(0, t), *[c[k] for c in chunks]]) for k, t in ((1, np.int64), (2, np.int32)))
    order = np.lexsort((y, ids))
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order), dtype=np.int32)
    cuts = np.cumsum([len(c[1]) for c in chunks])[:-1]
    place = dict(zip([c[0] for c in chunks], np.split(number, cuts), strict=True))
    ids, y = ids[order], y[order]
    w = np.ones((len(ids), levels))
    for key, own in weights:
        w[np.searchsorted(ids, key):np.searchsorted(ids, key, "right")] = own
    return place, y, w


def fit_models(train: DataFrame, configs: list[dict], oversample_min_count: int = 0,
               label: str = LABEL, counted: DataFrame | None = None,
               max_steps: int = svm.MAX_STEPS) -> TrainedModel:
    """MDL-6/7: feature space and one-vs-rest SVMs on all rows of ``train`` for every config
    (C, class_weight and, where it is not ``oversample_min_count``, its own level).

    Oversampled copies are row weights in the loss, in the ``balanced`` weights and in the
    training accuracy; the feature space counts every training row once. ``counted`` gives the
    document frequencies of a saved vocabulary where they are known already. The model is the same for
    any partitioning up to the order of floating-point sums.
    """
    spark = train.sparkSession
    configs = [{"oversample_min_count": oversample_min_count, **c} for c in configs]
    levels = sorted({c["oversample_min_count"] for c in configs})
    gc.collect()
    spark.sparkContext._jvm.System.gc()  # what earlier fits have shuffled goes when nothing refers to it any more
    slim = write_table(train.select("row_id", label, "amount_log", FE.entry_estimate(train).alias("entries")), "fit-rows")
    ff = FE.planned_features(train, slim, counted)
    labels = sorted(r[0] for r in slim.select(label).distinct().collect())  # the model's own classes
    if len(labels) < 2:
        raise ValueError("training split needs at least two labels")
    number = {x: i for i, x in enumerate(labels)}
    n_parts = FE.part_count(slim, "entries")
    records = PT.deal(FE.feature_rows(ff, train.withColumn("_id", F.xxhash64("row_id")), ["_id", label]), n_parts)
    chunks = PT.kept_rows(records).map(lambda r: (
        r[0], np.array([x[0] for x in r[1]], np.int64), np.array([number[x[1]] for x in r[1]], np.int32))).collect()
    copied = row_weights(slim, levels, label).where("row_id is not null").select(F.xxhash64("row_id"), "w").collect()
    place, y, w = _numbered(chunks, copied, len(levels))
    del chunks
    n, k = len(y), len(labels)
    matrix = PT.Matrix.of(records, n_parts, n, place)

    counts = np.stack([np.bincount(y, w[:, i], k) for i in range(len(levels))])
    # A higher level keeps the copies of a lower one, so levels of equal counts weigh every row alike.
    same = [int(np.flatnonzero((counts == own).all(1))[0]) for own in counts]
    level = np.array([same[levels.index(c["oversample_min_count"])] for c in configs])
    balanced = counts.sum(1)[:, None] / (k * np.maximum(counts, 1e-300))
    problems = svm.Problems(
        np.tile(np.arange(k), len(configs)), np.repeat([float(c["C"]) for c in configs], k),
        np.concatenate([balanced[lev] if c.get("class_weight") == "balanced" else np.ones(k)
                        for c, lev in zip(configs, level, strict=True)]), np.repeat(level, k))
    cells = np.stack([problems.cost, problems.positive, problems.level], 1).reshape(len(configs), -1)
    seen: dict = {}
    twin = [seen.setdefault(own.tobytes(), c) for c, own in enumerate(cells)]
    alone = sorted(set(twin))
    duals, right = held_numbers((len(alone), k, n)), np.zeros((len(alone), n), bool)
    first = np.zeros((n, k), np.float32)
    gap, settled = np.zeros((len(alone), k)), np.zeros((len(alone), k), bool)
    if n <= svm.LANDMARKS:
        gram = matrix.times(np.eye(n))
        white = svm.whitening(gram)
        z = gram @ white
        v, gaps, done = svm.in_turn(lambda v, own: svm.loss_and_gradient(z, y, w, v, own), z.T @ z, problems, max_steps)
        for i, c in enumerate(alone):
            own = slice(c * k, (c + 1) * k)
            duals[i], gap[i], settled[i] = (white @ v[:, own]).T, gaps[own], done[own]
            right[i] = (z @ v[:, own]).argmax(1) == y
        first[:] = z @ v[:, :k]
    else:
        step = max(1, svm.SPAN_BYTES // (n * svm.SPAN_NUMBERS))
        best = np.full((len(alone), n), -np.inf, np.float32)
        chosen = np.zeros((len(alone), n), np.int32)
        columns = [(i, j) for i in range(len(alone)) for j in range(k)]
        for own in np.array_split(np.arange(len(columns)), -(-len(columns) // step)):
            at = np.array([alone[columns[x][0]] * k + columns[x][1] for x in own])
            a, m, own_gap, own_settled = svm.span_minimise(matrix.times, y, w, problems.take(at), max_steps)
            for x, dual, margin, *told in zip(own, a, m, own_gap, own_settled, strict=True):
                i, j = columns[x]
                duals[i, j] = dual
                gap[i, j], settled[i, j] = told
                better = margin > best[i]  # ties take the first class
                best[i, better], chosen[i, better] = margin[better], j
                if alone[i] == 0:
                    first[:, j] = margin
        right = chosen == y
    place = [alone.index(c) for c in twin]
    return TrainedModel(ff, labels, matrix, duals, place, configs, gap.max(1)[place].tolist(),
                        settled.all(1)[place].tolist(), y, w, right, first, levels, spark)


def fit_model(train: DataFrame, C: float = 1.0, class_weight: str | None = None,
              oversample_min_count: int = 0) -> TrainedModel:
    """One config (the reference's ``build_classifier(C, class_weight)``)."""
    return fit_models(train, [{"C": C, "class_weight": class_weight}], oversample_min_count)


def train_accuracy(tm: TrainedModel) -> DataFrame:
    """(cfg, train_accuracy, train_size): every training row, copies by weight."""
    out = []
    for c, place in enumerate(tm.place):
        w = tm.w[:, tm.level_of(c)]
        out.append((c, float(w[tm.right[place]].sum() / w.sum()), int(w.sum())))
    return tm.session.createDataFrame(out, "cfg int, train_accuracy double, train_size bigint")


def confidence(m: np.ndarray, calibration: dict) -> np.ndarray:
    """Sigmoids of margins, normalised per row."""
    p = 1.0 / (1.0 + np.exp(np.clip(calibration["a"] * m + calibration["b"], -700, 700)))
    total = p.sum(1, keepdims=True)
    return np.where(total > 0, p / np.where(total > 0, total, 1.0), 1.0 / m.shape[1])


def _predicted(rows: RDD, margins: RDD, bias: np.ndarray, labels: list, cfgs: list, calibration: dict | None) -> RDD:
    """(kept values, config, predicted label, confidence) of each row: the arg-max of the margins
    or, for the first config if calibrated, of their sigmoids (ties take the first class)."""
    def work(chunk):
        kept, m = chunk[1]
        m = bias if m is None else m + bias
        m = np.broadcast_to(m, (len(kept), len(bias))).astype(float)
        for c in cfgs:
            own, prob = m, None
            if calibration is not None and c == 0:
                own = confidence(m, calibration)
                prob = own.max(1).tolist()
            best = own.argmax(1).tolist()
            for i, k in enumerate(kept):
                yield (*k, c, labels[best[i]], prob and prob[i])
    return rows.leftOuterJoin(margins).flatMap(work)


def score(tm: TrainedModel, df: DataFrame, keep: list[str] | None = None,
          calibration: dict | None = None) -> DataFrame:
    """MDL-3: one row per (input row, config) with ``cfg`` and ``predicted``; with a
    calibration also ``max_prob``. The rows' entries go to the parts that hold their features, and
    what comes back are margins of rows."""
    keep = keep or [c for c in df.columns if c not in ("text", FE.STORED, "idx", "val", "cfg", "predicted")]
    spark, out = df.sparkSession, None
    records = PT.deal(FE.feature_rows(tm.features, df, keep), tm.matrix.n_parts)
    scorer = PT.Scorer(tm.matrix, records)
    for i in sorted(set(tm.place)):
        f = np.asarray(tm.duals[i])
        own = _predicted(PT.kept_rows(records), scorer.margins(f), f.sum(1), tm.labels,
                         [c for c, place in enumerate(tm.place) if place == i], calibration)
        out = own if out is None else out.union(own)
    schema = ST.StructType([*[ST.StructField(x.name, x.dataType) for x in df.select(*keep).schema], ST.StructField("cfg", ST.IntegerType()),
                            ST.StructField("predicted", ST.StringType()), ST.StructField("max_prob", ST.DoubleType())])
    got = spark.createDataFrame(out, schema, verifySchema=False)
    return got if calibration is not None else got.drop("max_prob")


# ---------------------------------------------------------------- MDL-4 calibration

def sigmoid_sums(m: np.ndarray, t: np.ndarray, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(6, classes): loss, gradient (2) and Hessian (3) of the weighted cross-entropy of
    p = 1 / (1 + exp(a m + b)) against the targets ``t``, over some rows."""
    f = np.clip(a * m + b, -700, 700)
    p = 1 / (1 + np.exp(f))
    w = w[:, None]
    g, h = w * (t - p), w * p * (1 - p)
    loss = w * (np.logaddexp(0, f) - (1 - t) * f)
    return np.stack([x.sum(0) for x in (loss, g * m, g, h * m * m, h * m, h)])


def newton_sigmoids(evaluate, pos: np.ndarray, neg: np.ndarray, rounds: int = 60, tol: float = 1e-6) -> dict:
    """Damped Newton steps for all classes at once; ``evaluate(a, b)`` gives ``sigmoid_sums``
    over all rows. A class whose step does not lower its loss halves it."""
    a, b = np.zeros(len(pos)), np.log((neg + 1.0) / (pos + 1.0))
    sums = evaluate(a, b)
    step, moved = np.ones(len(pos)), np.full(len(pos), np.inf)
    for _ in range(rounds):
        loss, ga, gb, haa, hab, hbb = sums
        haa, hbb = haa + 1e-10, hbb + 1e-10
        det = np.maximum(haa * hbb - hab * hab, 1e-300)
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        new_a, new_b = a - step * da, b - step * db
        new = evaluate(new_a, new_b)
        good = new[0] <= loss + 1e-10 * np.abs(loss)
        moved = np.where(good, np.abs(step * da) + np.abs(step * db), moved)
        a, b = np.where(good, new_a, a), np.where(good, new_b, b)
        sums = np.where(good, new, sums)
        small = step < 1e-8
        step = np.where(good, 1.0, step / 2)
        if ((moved < tol) | small).all():
            break
    return {"a": a, "b": b, "converged": moved < 1e-3}


def fit_calibration(tm: TrainedModel) -> dict:
    """Per-class sigmoid p = 1 / (1 + exp(a m + b)) of the first config's margins with Platt's
    smoothed targets, on all training rows (copies by weight): every Newton step is one
    aggregation of class-wise loss, gradient and Hessian sums. ``converged`` tells per class."""
    spark, k, level = tm.session, len(tm.labels), tm.level_of(0)
    cut = range(0, len(tm.y), svm.BLOCK_ROWS)
    blocks = spark.sparkContext.parallelize(
        [tuple(np.ascontiguousarray(x[lo:lo + svm.BLOCK_ROWS]).tobytes() for x in (tm.y, tm.w, tm.first)) for lo in cut])
    rows = svm.Rows(write_table(spark.createDataFrame(blocks, "y binary, w binary, z binary"), "margins"))

    pos = rows.summed(lambda y, w, z: np.bincount(y, w[:, level], k)[None, :], (1, k))[0]
    neg = pos.sum() - pos
    high, low = (pos + 1.0) / (pos + 2.0), 1.0 / (neg + 2.0)

    def evaluate(a, b):
        def part(y, w, z):
            t = np.where(y[:, None] == np.arange(k), high, low)
            return sigmoid_sums(z, t, w[:, level], a, b)
        return rows.summed(part, (6, k))

    out = newton_sigmoids(evaluate, pos, neg)
    rows.release()
    return out
