"""The training rows by feature, and fits in the span of all of them."""

import numpy as np
from pyspark.sql import functions as F

from spendlens.operators import features as FE
from spendlens.operators import parts as PT
from spendlens.operators import svm
from spendlens.operators import train as TR
from spendlens.plans import evaluate as EV


def _weights(x, block):
    df = (x > 0).sum(0)
    w = np.where(x > 0, (1 + np.log(np.maximum(x, 1))) * (np.log((len(x) + 1) / (df + 1)) + 1), 0.0)
    w[:, block == 3] = x[:, block == 3]
    w[:, df < PT.LEAST[block]] = 0
    for b in range(3):
        norm = np.sqrt((w[:, block == b] ** 2).sum(1, keepdims=True))
        w[:, block == b] /= np.where(norm > 0, norm, 1)
    return w


def test_a_part_multiplies_like_a_matrix(monkeypatch):
    monkeypatch.setattr(PT, "CHUNK", 50)
    monkeypatch.setattr(PT, "SLAB_CELLS", 100)
    rng = np.random.default_rng(0)
    x = (rng.random((60, 200)) < np.linspace(0.01, 0.6, 200)) * rng.integers(1, 4, (60, 200))
    x[:, 0], x[3, 0] = 0, 2
    row, col = np.nonzero(x)
    block = np.arange(200) % 4
    for wide_from in (0, 4, 1000):  # all by entry, both ways, all in slabs
        monkeypatch.setattr(PT, "WIDE_FROM", wide_from)
        part = PT.Part.of(60, col * 7919 - 300, row, block[col].astype(np.int8), x[row, col].astype(np.float32))
        part = PT.Part.loads(part.normalised(part.norms()).dumps())
        w = _weights(x, block)
        for f in (rng.normal(size=(3, 60)), rng.normal(size=(4, 60)).astype(np.float32)):
            out = np.zeros_like(f)
            part.times(f, out)
            assert np.allclose(out + f * part.squares(), f @ w @ w.T, atol=1e-3)
            at, hit = part.known(np.arange(-1, 200) * 7919 - 300)
            assert np.allclose(part.weights(f.astype(np.float32))[at].T, (f @ w)[:, hit - 1], atol=1e-3)
        assert len(part.key) == ((x > 0).sum(0) >= np.maximum(1, PT.LEAST[block])).sum()


def test_a_fit_in_the_span_of_all_rows_reaches_the_minimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(150, 12))
    y = (x[:, :3] + 0.5 * rng.normal(size=(150, 3))).argmax(1)
    w = np.stack((np.ones(150), 1.0 + (rng.random(150) < 0.2)), 1)
    p = svm.Problems(np.tile(np.arange(3), 3), np.repeat([0.5, 4.0, 1.0], 3), np.repeat([1.0, 1.0, 2.5], 3), np.repeat([0, 1, 1], 3))
    asked = []
    a, m, gap, settled = svm.span_minimise(lambda f: asked.append(len(f)) or f @ x @ x.T, y, w, p, 400, 1e-6)
    want = svm.minimise(lambda v, cols: svm.loss_and_gradient(x, y, w, v, p.take(cols)), x.T @ x, p, 400, 1e-9)[0]
    assert settled.all() and np.allclose(m, a @ x @ x.T, atol=1e-2) and np.allclose(x.T @ a.T, want, atol=1e-2)
    assert asked[-1] < 9  # settled columns are left out
    assert not svm.span_minimise(lambda f: f @ x @ x.T, y, w, p, 2)[3].any()


def _rows(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(90):
        own = rng.choice(words, 6).tolist() + [f"mark{i % 3}"] * (i % 4 > 0)
        out.append((f"r{i // 2}" if i > 2 else None, " ".join(own), f"item {i % 11}", f"v{i % 5}", float(i % 7), f"l{i % 3}"))
    return spark.createDataFrame(out, "row_id string, text string, item_key string, vendor_id string, amount_log double, account_name string")


def test_every_training_row_has_a_say_however_many_there_are(spark, monkeypatch):
    df = _rows(spark)  # ids are null or come twice
    configs = [{"C": 1.0, "class_weight": None}, {"C": 2.0, "class_weight": "balanced"}, {"C": 1.0, "class_weight": None}]
    local = svm.minimise
    monkeypatch.setattr(svm, "minimise", lambda e, z, p, n: local(e, z, p, n, 1e-9))
    whole = TR.fit_models(df, configs)  # products of all pairs of rows at once
    monkeypatch.setattr(svm, "LANDMARKS", 10)  # a fit that once saw 10 rows' span
    monkeypatch.setattr(svm, "SPAN_BYTES", 90 * svm.SPAN_NUMBERS * 2)  # two columns at a time
    spans = []
    minimise = svm.span_minimise
    monkeypatch.setattr(svm, "span_minimise", lambda t, y, w, p, n: spans.append((len(y), len(p.cls))) or minimise(t, y, w, p, n, 1e-7))
    got = TR.fit_models(df.repartition(5), configs)
    assert spans == [(90, 2)] * 3 and got.coefficients.shape == (90, 3, 3)
    assert np.allclose(got.first, whole.first, atol=0.02) and (got.right == whole.right).all()
    assert (np.abs(got.coefficients[:, 0]).sum(1) > 0).sum() > 10 and got.place == [0, 1, 0]
    scored = {c: TR.score(m, df, keep=["row_id", "text"]).orderBy("cfg", "row_id", "text").collect() for c, m in (("got", got), ("whole", whole))}
    assert scored["got"] == scored["whole"] and len(scored["got"]) == 270
    accuracy = {r["cfg"]: r["train_accuracy"] for r in TR.train_accuracy(got).collect()}
    labels = TR.score(got, df, keep=["account_name"])
    for r in labels.groupBy("cfg").agg(F.avg((F.col("account_name") == F.col("predicted")).cast("double")).alias("a")).collect():
        assert abs(r["a"] - accuracy[r["cfg"]]) < 0.01


def test_a_store_is_written_once_and_a_single_fit_makes_none(spark, monkeypatch):
    df = _rows(spark).where("row_id is not null")
    store = FE.term_store(df)
    made, cuts = [], []
    write = EV.write_table
    monkeypatch.setattr(EV, "write_table", lambda x, name: cuts.append((name, FE.STORED in x.columns)) or write(x, name))
    monkeypatch.setattr(FE, "term_store", lambda x: made.append(1))
    by_store, by_text = (EV.evaluate_balanced(x).first() for x in (store, df))
    assert by_store == by_text and not made
    assert not any(stored for _, stored in cuts) and [name for name, _ in cuts].count("balanced") == 1
