"""Packed terms, vectorised n-gram keys, blocks of training rows and column groups of a fit."""

import tracemalloc

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from spendlens.functions.hashes import HashTable
from spendlens.operators import features as FE
from spendlens.operators import svm
from spendlens.operators import tfidf as T
from spendlens.operators import train as TR
from spendlens.plans import catalog
from spendlens.session import write_table

from conftest import SF_SMALL

TEXTS = [None, "", " ", "a", "a b  a ab abc abcd abcde abcdef", "é b ab Ünder naïve b", "x\ty z\n1 ", "日本 語 a日b", "long" * 30 + " a"]


def test_counted_terms_have_the_keys_and_counts_of_their_strings():
    for text in TEXTS:
        b, key, tf = FE._counted(text, "alpha beta alpha")
        got = {(x, y): z for x, y, z in zip(b.tolist(), key.view(np.uint64).tolist(), tf.tolist())}
        want = {(i, xxhash.xxh64_intdigest(t, i)): n for i, block in enumerate(T.BLOCKS)
                for t, n in T.counted_terms(text if block.column == "text" else "alpha beta alpha", block).items()}
        assert got == want and len(got) == len(b)


def test_packed_terms_come_back(spark):
    rows = [FE._counted(t, t) for t in TEXTS]
    for row in rows:
        assert all(np.array_equal(x, y) for x, y in zip(row, FE._unpacked(FE._packed(row)), strict=True))
    assert all(len(x) == 0 for x in FE._unpacked(None))
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(TEXTS)], "row_id int, text string, item_key string")
    store = FE.counted_rows(df, ["row_id"])
    assert dict(store.dtypes)[FE.STORED] == "binary"
    for source in (df, store):  # what a join reads is a list of structs either way
        for r in FE.with_terms(source, ["row_id"]).collect():
            assert [tuple(t) for t in r[FE.STORED]] == list(zip(*(x.tolist() for x in rows[r["row_id"]]), strict=True))


def test_kernels_of_frequent_and_rare_features(monkeypatch):
    rng = np.random.default_rng(5)
    dense = rng.random((40, 60)) * (rng.random((40, 60)) < np.linspace(0.02, 0.9, 60))
    rows = [(np.flatnonzero(r) * 7 - 100, r[r > 0]) for r in dense]
    want = 1 + dense @ dense.T
    for cells in (0, 40 * 10, 1 << 20):
        monkeypatch.setattr(svm, "DENSE_CELLS", cells)
        monkeypatch.setattr(svm, "KERNEL_CELLS", 100)
        sample = svm.Sample.of([r[0] for r in rows], [r[1] for r in rows])
        got = sample.kernels([*rows, (np.zeros(0, np.int64), np.zeros(0))])
        assert np.allclose(got[:-1], want, atol=1e-5) and (got[-1] == 1).all()
        assert "dense" not in sample.__getstate__()


def test_rows_are_summed_whole_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(6)
    z = rng.normal(size=(300, 4)).astype(np.float32)
    df = spark.createDataFrame([(i % 3, [1.0, float(i)], bytearray(x.tobytes())) for i, x in enumerate(z)],
                               "y int, w array<double>, z binary")
    for n in (1, 7):
        rows = svm.Rows(write_table(svm.in_blocks(df.repartition(n)), "rows"))
        for limit in (svm.DIRECT_BYTES, 0):  # straight to the driver, and met in parts first
            monkeypatch.setattr(svm, "DIRECT_BYTES", limit)
            got = rows.summed(lambda y, w, z: np.concatenate((z.T @ z, np.bincount(y, w[:, 1], 4)[None])), (5, 4))
            assert np.allclose(got[:4], z.astype(float).T @ z)
            assert np.allclose(got[4, :3], [sum(range(k, 300, 3)) for k in range(3)])
            monkeypatch.undo()
        rows.release()
        assert rows.summed(lambda y, w, z: np.array([len(y)]), (1,))[0] == 300


def test_columns_in_turn_equal_all_at_once(monkeypatch):
    rng = np.random.default_rng(7)
    z, y, w = rng.normal(size=(90, 6)), rng.integers(0, 3, 90), np.ones((90, 1))
    p = svm.Problems(np.tile(np.arange(3), 3), np.repeat([0.5, 1.0, 4.0], 3), np.ones(9), np.zeros(9, int))
    widths = []

    def evaluate(v, own):
        widths.append(v.shape[1])
        return svm.loss_and_gradient(z, y, w, v, own)
    whole = svm.in_turn(evaluate, z.T @ z, p)
    assert max(widths) == 9
    widths.clear()
    monkeypatch.setattr(svm, "COLUMNS", 4)
    parts = svm.in_turn(evaluate, z.T @ z, p)
    assert max(widths) <= 4
    assert all(np.allclose(a, b) for a, b in zip(whole, parts, strict=True))


def test_two_evaluations_of_a_query_share_a_term_store(spark, monkeypatch):
    made = []
    store = FE.term_store
    monkeypatch.setattr(FE, "term_store", lambda df: made.append(1) or store(df))
    assert catalog.QUERIES["eval_holdout"](spark, SF_SMALL).count() == 2
    assert len(made) == 1


def test_row_vectors_ascend_with_every_feature_once():
    key = np.array([-5, 2, 9, 2**62])
    idx, val = FE._row_vector(np.array([0, 2, 0, 2]), key, np.array([3.0, 1.0, 4.0, 0.0]), "v", 0.5, 3)
    others = {FE.feature_key(FE.BIN, b"3"): 1.0, FE.feature_key(FE.VENDOR, b"v"): 1.0, FE.feature_key(FE.AMOUNT, b""): 0.5}
    assert (np.diff(idx) > 0).all()
    assert dict(zip(idx.tolist(), val.tolist(), strict=True)) == {-5: 0.6, 2: 1.0, 9: 0.8, 2**62: 0.0, **others}
    idx, val = FE._row_vector(np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0), None, 0.0, 0)
    assert idx.tolist() == [FE.feature_key(FE.BIN, b"0")] and val.tolist() == [1.0]


def test_the_full_fit_counts_its_terms_once(spark, monkeypatch):
    texts = []
    count = FE.counted_rows
    monkeypatch.setattr(FE, "counted_rows", lambda df, keep: texts.append(1) or count(df, keep))
    frequencies = FE.document_frequencies
    stored = []
    monkeypatch.setattr(FE, "document_frequencies", lambda df, parts: stored.append(FE.STORED in df.columns) or frequencies(df, parts))
    assert catalog.QUERIES["fit_full_model"](spark, SF_SMALL).columns == ["row_id", "account_name", "predicted"]
    assert len(texts) == 1 and stored == [True]


def test_kernels_hold_few_products_at_once(monkeypatch):
    monkeypatch.setattr(svm, "DENSE_CELLS", 0)  # every feature is a rare one
    rng = np.random.default_rng(8)
    rows = [(np.sort(rng.choice(4000, 2000, False)), rng.random(2000)) for _ in range(128)]
    sample = svm.Sample.of([r[0] for r in rows], [r[1] for r in rows])
    tracemalloc.start()
    got = sample.kernels(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    full = np.zeros((128, 4000))
    for i, (idx, val) in enumerate(rows):
        full[i, idx] = val
    assert np.allclose(got, 1 + full @ full.T, rtol=1e-5)
    assert peak < 100e6  # some 16 M products in all, 128 MB for one array of them
    assert svm.runs([3, 9, 1, 1, 1], 4, 2) == [(0, 1), (1, 2), (2, 4), (4, 5)] and svm.runs([], 4, 2) == []


def test_lists_come_as_views():
    lists = [[1, 2], [], [3]]
    column = pa.chunked_array([pa.array(lists[:1], pa.list_(pa.int64())), pa.array(lists[1:], pa.list_(pa.int64()))])
    assert [x.tolist() for x in TR._list_arrays(column)] == lists
    assert TR._list_arrays(pa.chunked_array([], pa.list_(pa.int64()))) == []


def test_hashes_are_found_as_by_bisection():
    rng = np.random.default_rng(9)
    for n in (0, 1, 2, 5, 100, 3000):
        for keys in (np.unique(rng.integers(-2**63, 2**63 - 1, n)), np.arange(n) * 3):
            asked = np.concatenate((keys, rng.integers(-2**63, 2**63 - 1, 60), [-2**63, 2**63 - 1, 0, 4]))
            at, hit = HashTable(keys).find(asked)
            assert hit.tolist() == np.flatnonzero(np.isin(asked, keys)).tolist()
            assert (keys[at[hit]] == asked[hit]).all()


def test_equal_columns_are_minimised_once():
    rng = np.random.default_rng(10)
    z, y = rng.normal(size=(90, 6)), rng.integers(0, 3, 90)
    w = np.repeat([[1.0, 1.0]], 90, 0)
    w[::7, 1] = 3.0
    level = np.repeat([0, 1, 0, 0], 3)
    p = svm.Problems(np.tile(np.arange(3), 4), np.repeat([0.5, 0.5, 0.5, 4.0], 3), np.ones(12), level)
    widths = []

    def evaluate(v, own):
        widths.append(v.shape[1])
        out = np.zeros((7, v.shape[1]))
        for x, c, weight in zip(z, y, w, strict=True):
            sign = np.where(own.cls == c, 1.0, -1.0)
            slack = np.maximum(0, 1 - sign * (x @ v))
            force = weight[own.level] * own.cost * np.where(sign > 0, own.positive, 1.0)
            out[0] += force * slack ** 2
            out[1:] += -2 * x[:, None] * (sign * force * slack)
        assert np.allclose(out, svm.loss_and_gradient(z, y, w, v, own))
        return out
    v, gap, settled = svm.in_turn(evaluate, z.T @ z, p)
    assert max(widths) == 9 and v.shape == (6, 12) and len(gap) == len(settled) == 12
    alone = svm.minimise(lambda v, cols: evaluate(v, p.take(cols)), z.T @ z, p)
    assert np.allclose(v, alone[0])
    assert np.array_equal(v[:, :3], v[:, 6:9]) and not np.allclose(v[:, :3], v[:, 3:6])


def test_levels_without_minorities_are_one_problem(spark, monkeypatch):
    rows = [(f"r{i}", f"alpha t{i % 7} w{i % 3}", f"i{i}", f"v{i % 2}", float(i % 5), f"l{i % 2}" if i < 36 else "rare")
            for i in range(39)]
    df = spark.createDataFrame(rows, "row_id string, text string, item_key string, vendor_id string, "
                                     "amount_log double, account_name string")
    widths = []
    step = svm.minimise
    monkeypatch.setattr(svm, "minimise", lambda e, m, p, *a: widths.append(len(p.cls)) or step(e, m, p, *a))
    configs = [{"C": c, "class_weight": None, "oversample_min_count": o} for c in (0.5, 2.0) for o in (0, 2, 3, 9)]
    tm = TR.fit_models(df, configs)
    assert widths == [2 * 2 * 3]  # levels 2 and 3 copy no row; 9 copies the rare ones
    apart = [TR.fit_models(df, [c]) for c in configs]
    for c, own in enumerate(apart):
        assert np.allclose(tm.coefficients[:, c], own.coefficients[:, 0], atol=1e-6)
    accuracy = TR.train_accuracy(tm).orderBy("cfg").collect()
    for c, own in enumerate(apart):
        (_, good, size), = TR.train_accuracy(own).collect()
        assert (accuracy[c]["train_accuracy"], accuracy[c]["train_size"]) == (good, size)
    assert [r["train_size"] for r in accuracy] == [39, 39, 39, 45] * 2
    got = TR.score(tm, df, keep=["row_id"]).collect()
    assert len(got) == 39 * 8
    for c, own in enumerate(apart):
        want = {r["row_id"]: r["predicted"] for r in TR.score(own, df, keep=["row_id"]).collect()}
        assert {r["row_id"]: r["predicted"] for r in got if r["cfg"] == c} == want


def test_a_run_and_its_models_share_a_term_store(spark, monkeypatch):
    made = []
    store = FE.term_store
    monkeypatch.setattr(FE, "term_store", lambda df: made.append(1) or store(df))
    monkeypatch.setattr(catalog.EV, "tune_grid", lambda df, **k: spark.createDataFrame(
        [(1.0, "None", 0, 0.5, 0.5, 0)], "C double, class_weight string, oversample_min_count int, "
        "val_accuracy_mean double, val_macro_f1_mean double, grid_pos int"))
    monkeypatch.setattr(catalog, "_RUNS", {})
    monkeypatch.setattr(catalog, "_GRIDS", {})
    assert catalog.QUERIES["model_champion_metrics"](spark, SF_SMALL).count() == 6
    assert len(made) == 1
    made.clear()
    assert catalog.QUERIES["tune_two_stage"](spark, SF_SMALL).where(F.col("C") == 1.0).count() == 1
    assert len(made) == 1


def test_a_run_is_tuned_over_the_whole_grid(spark, monkeypatch):
    asked = []

    def grid(df, *args, **kwargs):
        asked.append((args, kwargs, df.count()))
        return spark.createDataFrame([(1.0, "None", 0, 0.5, 0.5, 0)], "C double, class_weight string, "
                                     "oversample_min_count int, val_accuracy_mean double, val_macro_f1_mean double, grid_pos int")
    monkeypatch.setattr(catalog.EV, "tune_grid", grid)
    monkeypatch.setattr(catalog.EV, "tune_two_stage", lambda df, grid: {"best": grid})
    monkeypatch.setattr(catalog.SM, "run_evaluations", lambda df, tuned: None)
    monkeypatch.setattr(catalog.SM, "write_summary", lambda *a: None)
    monkeypatch.setattr(catalog, "_RUNS", {})
    monkeypatch.setattr(catalog, "_GRIDS", {})
    _, tuned, store = catalog._model_run(spark, SF_SMALL)
    assert asked == [((), {}, store.count())]  # no part of the grid, of its splits or of the rows
    assert tuned == {"C": 1.0, "class_weight": None, "oversample_min_count": 0}
