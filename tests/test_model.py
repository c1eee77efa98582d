"""Model-level invariants at sf0.01 (quality gate: the model beats the lookup baseline)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spendlens.operators import features as FE
from spendlens.operators import lookup as LK
from spendlens.operators import metrics as M
from spendlens.operators import split as S
from spendlens.operators import svm
from spendlens.operators import train as TR
from spendlens.plans import evaluate as EV
from spendlens.plans.catalog import expenses

from conftest import SF_MEDIUM, SF_SMALL


def test_model_beats_lookup_baseline_on_same_split(spark):
    s = S.group_split(FE.term_store(expenses(spark, SF_MEDIUM)))
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    tm = TR.fit_models(train, [{"C": 1.0, "class_weight": None}, {"C": 1.0, "class_weight": "balanced"},
                               {"C": 1.0, "class_weight": None, "oversample_min_count": 15}])
    pred = TR.score(tm, test)
    base = LK.accuracy(LK.lookup_predict(train, test)).first()["accuracy"]
    for c in range(3):
        acc = M.evaluation_summary(pred.where(F.col("cfg") == c))["accuracy"]
        assert acc > base
    own = {r["cfg"]: r for r in TR.train_accuracy(tm).collect()}
    assert all(r["train_accuracy"] >= 0.9 for r in own.values()) and tm.converged[0]
    # copies are row weights: the sizes are those of the oversampled table
    assert own[0]["train_size"] == train.count()
    assert own[2]["train_size"] == S.oversample_minority(train, 15).count()
    # the pass over the coordinates gives what scoring the rows gives
    scored = TR.score(tm, train).where("cfg = 0")
    assert abs(M.evaluation_summary(scored)["accuracy"] - own[0]["train_accuracy"]) < 0.01
    # calibrated probabilities are normalised and in [0, 1]
    cal = TR.fit_calibration(tm)
    assert cal["converged"].all()
    probs = TR.score(tm, test, calibration=cal).where("cfg = 0")
    lo, hi = probs.agg(F.min("max_prob"), F.max("max_prob")).first()
    assert 0.0 < lo <= hi <= 1.0


def _problem(rng, n=150, dims=8, k=3):
    z = rng.normal(size=(n, dims))
    y = (z[:, :k] + 0.5 * rng.normal(size=(n, k))).argmax(1)
    w = np.stack((np.ones(n), 1.0 + (rng.random(n) < 0.2)), 1)
    return z, y, w


def test_minimiser_reaches_a_stationary_point_with_weights_equal_to_copies():
    rng = np.random.default_rng(0)
    z, y, w = _problem(rng)
    p = svm.Problems(np.tile(np.arange(3), 3), np.repeat([0.5, 4.0, 1.0], 3), np.repeat([1.0, 1.0, 2.5], 3), np.repeat([0, 1, 1], 3))
    v, gap, settled = svm.minimise(lambda x, cols: svm.loss_and_gradient(z, y, w, x, p.take(cols)), z.T @ z, p, 400, 1e-9)
    assert settled.all() and gap.max() < 1e-4
    for c in range(9):
        copies = np.repeat(np.arange(len(z)), w[:, p.level[c]].astype(int))
        sign = np.where(y[copies] == p.cls[c], 1.0, -1.0)
        cost = p.cost[c] * np.where(sign > 0, p.positive[c], 1.0)

        def loss(x, sign=sign, cost=cost, copies=copies):
            return 0.5 * x @ x + (cost * np.maximum(0, 1 - sign * (z[copies] @ x)) ** 2).sum()
        best = loss(v[:, c])
        assert all(best <= loss(v[:, c] + 0.01 * rng.normal(size=8)) + 1e-6 * best for _ in range(20))


def test_pieces_of_rows_add_up(monkeypatch):
    rng = np.random.default_rng(3)
    z, y, w = _problem(rng)
    p = svm.Problems(np.arange(3), np.ones(3), np.ones(3), np.zeros(3, int))
    v = rng.normal(size=(8, 3))
    whole = svm.loss_and_gradient(z, y, w, v, p)
    monkeypatch.setattr(svm, "PIECE_CELLS", 20)
    assert np.allclose(svm.loss_and_gradient(z, y, w, v, p), whole)


def test_sums_do_not_depend_on_partitions(spark):
    rows = [(i % 4, [float(i), 1.0, -2.0 * i]) for i in range(200)]
    df = spark.createDataFrame(rows, "y int, z array<float>")

    def part(batch):
        z = svm.lists(batch.column(1))
        return z.T @ z
    x = np.array([r[1] for r in rows])
    for n in (1, 7, 300):
        assert np.allclose(svm.summed(df.repartition(n), ["y", "z"], part, (3, 3)), x.T @ x)
    assert not svm.summed(df.where("false"), ["y", "z"], part, (3, 3)).any()


def test_newton_sigmoids_equal_a_local_fit():
    """Class-wise sums give the minimum that a fine search around it cannot better."""
    rng = np.random.default_rng(2)
    y = rng.integers(0, 3, 400)
    m = np.where(y[:, None] == np.arange(3), 1.0, -1.0) + rng.normal(size=(400, 3))
    own = (y[:, None] == np.arange(3))
    pos, w = own.sum(0).astype(float), np.ones(400)
    neg = 400 - pos
    t = np.where(own, (pos + 1) / (pos + 2), 1 / (neg + 2))
    halves = (slice(0, 130), slice(130, 400))
    fit = TR.newton_sigmoids(lambda a, b: sum(TR.sigmoid_sums(m[h], t[h], w[h], a, b) for h in halves), pos, neg)
    assert fit["converged"].all() and (fit["a"] < 0).all()
    best = TR.sigmoid_sums(m, t, w, fit["a"], fit["b"])[0]
    for _ in range(30):
        a, b = fit["a"] + 0.02 * rng.normal(size=3), fit["b"] + 0.02 * rng.normal(size=3)
        assert (TR.sigmoid_sums(m, t, w, a, b)[0] >= best - 1e-6).all()


def test_kernel_equals_dense_products():
    rng = np.random.default_rng(1)
    dense = rng.random((6, 20)) * (rng.random((6, 20)) < 0.4)
    idx = [np.flatnonzero(r) * 1000 - 7 for r in dense]
    sample = svm.Sample.of(idx, [r[r > 0] for r in dense])
    gram = np.array([sample.kernel(i, r[r > 0]) for r, i in zip(dense, idx, strict=True)])
    assert np.allclose(gram, 1 + dense @ dense.T, atol=1e-5)
    assert np.allclose(sample.kernel(np.array([10**9]), np.array([1.0])), 1)
    white = svm.whitening(gram)
    assert np.allclose(white.T @ gram @ white, np.eye(white.shape[1]), atol=1e-5)


def test_landmarks_keep_every_label_and_do_not_depend_on_partitions(spark):
    rows = [(i, "hot" if i % 3 else f"label{i % 40}") for i in range(600)]
    df = spark.createDataFrame(rows, "row_id int, account_name string")
    got = [sorted(r["row_id"] for r in svm.landmark_rows(df.repartition(n), "account_name", limit=100).collect())
           for n in (1, 7)]
    assert got[0] == got[1] and len(got[0]) == 100
    names = dict(rows)
    assert {names[i] for i in got[0]} == set(names.values())


def test_same_model_for_any_partitioning(spark):
    s = FE.term_store(S.group_split(expenses(spark, SF_SMALL)).where("split = 'train'"))
    a, b = (TR.fit_model(s.repartition(n)) for n in (1, 5))
    assert a.labels == b.labels and np.allclose(a.coefficients, b.coefficients, atol=1e-3)


def test_grid_and_two_stage_selection(spark):
    df = expenses(spark, SF_SMALL)
    grid = EV.tune_grid(df, c_values=[0.5, 4.0], oversample_values=[0, 5], n_splits=2).cache()
    rows = grid.collect()
    assert len(rows) == 8 and sorted(r["grid_pos"] for r in rows) == list(range(8))
    for r in rows:
        assert 0 <= r["val_accuracy_mean"] <= 1 and r["val_accuracy_std"] >= 0
        assert abs(r["gap_mean"] - (r["train_accuracy_mean"] - r["val_accuracy_mean"])) < 1e-3
    best = EV.select_best(grid).first()
    top = max(r["val_macro_f1_mean"] for r in rows)
    assert best["grid_pos"] == min(r["grid_pos"] for r in rows if r["val_macro_f1_mean"] == top)
    assert EV.viable_configs(grid, 2.0).count() == 8  # no config reaches the floor: all go on
    high = sorted((r["val_accuracy_mean"] for r in rows), reverse=True)[2]
    assert EV.viable_configs(grid, high).count() >= 3
    two = EV.tune_two_stage(df, high, grid)
    second = {r["grid_pos"]: r["balanced_macro_f1"] for r in two["stage2"].collect()}
    assert set(second) == {r["grid_pos"] for r in rows if r["val_accuracy_mean"] >= high}
    assert two["best"].first()["balanced_macro_f1"] == max(second.values())


def test_learning_curve_fits_what_it_reports(spark):
    curve = sorted(EV.learning_curve(expenses(spark, SF_SMALL), n_splits=1).collect(), key=lambda r: r["train_fraction"])
    sizes = [r["train_size"] for r in curve]
    assert len(sizes) == 5 and sizes == sorted(set(sizes))
    whole = S.group_split(expenses(spark, SF_SMALL)).where("split = 'train'").count()
    assert sizes == [int(f * whole) for f in S.LEARNING_FRACTIONS]


@pytest.mark.parametrize("strategy", ["group_item", "random"])
def test_document_frequencies_of_all_splits_at_once(spark, strategy):
    df = expenses(spark, SF_SMALL)
    store, names, counted = EV.labelled_store(df, strategy, 2)
    for i, name in enumerate(names):
        train = store.where(name).drop(*names)
        own = FE.fit_features(train).vocab
        shared = FE.fit_features(train, counted(i)).vocab
        assert own.exceptAll(shared).isEmpty() and shared.exceptAll(own).isEmpty()
