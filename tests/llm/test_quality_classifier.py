"""Quality classifier: statistics and fit against plain computations, held-out accuracy."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from spendlens.llm import quality_classifier as Q
from spendlens.sources.tables import read_table

from tests.llm.fixtures import corpus, frame

SF = "/root/testdata/sf0.1"


def _brute_fit(x, y, pooled=Q.POOLED, ridge=Q.RIDGE):
    """log density ratio by textbook formulas, without factors or moments."""
    whole = sum(np.cov(x[y == k].T, bias=True) * (y == k).sum() for k in (0, 1)) / len(x)
    out = []
    for k in (0, 1):
        own = x[y == k]
        cov = (1 - ridge) * ((1 - pooled) * np.cov(own.T, bias=True) + pooled * whole) \
            + ridge * np.diag(np.maximum(np.diag(whole), 1e-6))
        out.append((own.mean(0), np.linalg.inv(cov), np.linalg.slogdet(cov)[1], np.log(len(own) / len(x))))

    def score(v):
        d = [p - 0.5 * (det + (v - m) @ inv @ (v - m)) for m, inv, det, p in out]
        return 1 / (1 + np.exp(np.clip(d[0] - d[1], -700, 700)))
    return score


def _table(spark, n=400):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        words = rng.choice(["the", "house", "of", "Many", "rivers", "is", "green"], rng.integers(3, 80))
        text = " ".join(words) if i % 4 else " ".join(f"{w}{'#$%&'[j % 4]}" for j, w in enumerate(words))
        rows.append((i, text, "en"))
    labels = [(i, int(i % 4 > 0)) for i in range(n) if i % 10]
    # ties and faults: repeated labels, contradictions, nulls, values beyond 0 and 1
    labels += [(1, 1), (2, 0), (3, None), (None, 1), (5, 7), (9999, 0)]
    return rows, spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id bigint, quality int, held_out int"), labels


def test_equals_brute_force(spark):
    rows, labels, known = _table(spark)
    rows += rows[:50] + [(None, "the green house", "en"), (None, None, None)]
    out = Q.classify_quality(frame(spark, rows), labels).collect()
    assert len(out) == len(rows)
    x = {i: Q.statistics((t or "").encode()) for i, t, _ in rows}
    seen: dict = {}
    for i, q in known:
        seen.setdefault(i, set()).add(q)
    learn = {(next(iter(q)), tuple(x[i])) for i, q in seen.items()
             if i is not None and i in x and q in ({0}, {1}) and zlib.crc32(str(i).encode()) % 5}
    y = np.array([q for q, _ in learn])
    score = _brute_fit(np.array([v for _, v in learn]), y)
    for r in out:
        t = dict((a, b) for a, b, _ in rows)[r["doc_id"]] if r["doc_id"] is not None else None
        if r["doc_id"] is not None:
            assert abs(r["score"] - score(np.array(Q.statistics((t or "").encode())))) < 1e-6
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        else:
            assert not r["held_out"]
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_awkward_texts_and_missing_classes(spark):
    rows = corpus()
    docs = frame(spark, rows)
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {(r["score"], r["predicted"]) for r in Q.classify_quality(docs, none).collect()} == {(0.5, 1)}
    for q in (0, 1):
        one = spark.createDataFrame([(i, q) for i in range(10, 60)], "doc_id bigint, quality int")
        out = Q.classify_quality(docs, one).collect()
        assert len(out) == len(rows) and {(r["score"], r["predicted"]) for r in out} == {(float(q), q)}
    two = spark.createDataFrame([(i, int(i < 60)) for i in range(10, 75)], "doc_id bigint, quality int")
    out = Q.classify_quality(docs, two).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    assert Q.classify_quality(docs.limit(0), two).collect() == []


def test_statistics_of_long_and_odd_texts(monkeypatch):
    text = "Das Haus, 7 Flüße und 12 ###\nzwei Zeilen\nzwei Zeilen\n\n".encode() * 40
    whole = Q.statistics(text)
    monkeypatch.setattr(Q, "PIECE_BYTES", 7)
    assert np.allclose(Q.statistics(text), whole)
    assert len(whole) == len(Q.STATISTICS) and np.isfinite(whole).all()
    for odd in (b"", b" \n", b"x" * 100, "é".encode() * 50, b"\n" * 9, b"\x00"):
        assert np.isfinite(Q.statistics(odd)).all()
    assert whole[0] == np.log1p(len(text.decode().split()))
    lines = [x for x in text.split(b"\n") if x.strip()]
    assert np.isclose(np.sin(whole[10]) ** 2, (len(lines) - len(set(lines))) / (len(lines) + Q.LEAST_LINES))


def test_shrunk_covariance_has_a_factor_for_one_row_and_constants():
    x = np.zeros((3, 4))
    x[1:] = 1
    n, total = np.array([1.0, 2.0]), np.stack((x[0], x[1:].sum(0)))
    outer = np.stack((np.outer(x[0], x[0]), x[1:].T @ x[1:]))
    model = Q.discriminant(n, total, outer)
    got = model.scores(np.array([[0.0] * 4, [1.0] * 4]))
    assert got[0] < 0.1 and got[1] > 0.9


def test_held_out_accuracy(spark):
    docs, labels = (read_table(spark, SF, t) for t in ("documents", "labels"))
    out = Q.classify_quality(docs, labels).join(labels, "doc_id").where("held_out")
    rate = {r["quality"]: r["right"] for r in out.groupBy("quality").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("double")).alias("right")).collect()}
    assert rate[0] > 0.95 and rate[1] > 0.98
