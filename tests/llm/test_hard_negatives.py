"""Hard negatives against brute force over all pairs."""

import random
from math import floor, isfinite

import numpy as np
import pytest

from spendlens.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, id bigint, row string, v string, score double"


def _rows(seed=5, n=300, dims=6):
    rng = random.Random(seed)
    hot = [0.25] * dims
    out = [(i, hot if i % 3 == 0 else [rng.gauss(0.3, 1) for _ in range(dims)], rng.choice([0, 0, 1, 2])) for i in range(n)]
    out += [(n, None, 1), (n + 50, [1.0, None] + [0.0] * (dims - 2), 1), (n + 100, [float("nan")] * dims, 0),
            (None, hot, 0), (n + 150, hot, None), (n + 200, [float("inf")] * dims, 2), (0, hot, None),
            (n + 250, [], 1), (n + 300, [2.0], 0), (n + 350, [-1.0] * dims, 9), (n + 400, [0.0] * dims, 1)]
    out += [out[1], out[1], out[50], (50, [rng.gauss(0, 1) for _ in range(dims)], 1), (7, [1.0] * dims, 0)]
    return out


def _brute(rows, every=50, positives=5, negatives=3):
    own = {(i, label, tuple(floor(256 * float(np.float32(x))) for x in v)) for i, v, label in rows
           if i is not None and label is not None and v is not None
           and all(x is not None and isfinite(x) for x in v)}
    out = []
    for a, la, va in own:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i, lab) for i, lab, v in own if i != a)
        for s, p, _ in [x for x in scored if x[2] == la][:positives]:
            inside = [x for x in sorted((-sum(x * y for x, y in zip(va, v, strict=False)), i) for i, lab, v in own if lab != la)
                      if 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(a, p, k, i, -s, -t) for k, (t, i) in enumerate(inside, 1)]
    return sorted(out)


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, label, 7, "row", "v", 0.5) for i, v, label in rows], SCHEMA)


def _mined(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("shard_rows, group", [(8192, 4096), (40, 3)])
def test_equals_brute_force(spark, monkeypatch, shard_rows, group):
    monkeypatch.setattr(H, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(H, "GROUP_ANCHORS", group)
    rows = _rows()
    expected = _brute(rows)
    assert len(expected) > 20
    assert _mined(H.hard_negatives(_frame(spark, rows))) == expected


def test_empty_tables_and_single_labels(spark):
    assert _mined(H.hard_negatives(_frame(spark, []))) == []
    assert _mined(H.hard_negatives(_frame(spark, [(50, [1.0], 0), (51, [2.0], 0)]))) == []
    assert _mined(H.hard_negatives(_frame(spark, [(50, [1.0], 0), (51, [2.0], 0), (52, [1.5], 1)]))) == [
        (50, 51, 1, 52, 2 * 256 * 256, 3 * 128 * 256)]


def _shard(rng, n, dims, low=-300, high=300):
    return H.Shard(np.arange(n), rng.integers(0, 3, n), rng.integers(low, high, (n, dims)))


def test_stops_early_and_keeps_ties():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 40, (5000, 4))
    x[:30] += 500  # a few rows far ahead in every dimension
    shard = H.Shard(np.arange(5000), np.zeros(5000, np.int64), x)
    met = 0
    best = H.Best(5)
    for rows, scores, threshold in shard.access(np.array([3, 1, 2, 5])):
        met += len(rows)
        best.offer(shard.ids[rows], scores)
        if best.settled(threshold):
            break
    full = x @ np.array([3, 1, 2, 5])
    order = np.lexsort((np.arange(5000), -full))[:5]
    assert best.ids.tolist() == order.tolist() and met < 500
    # All rows tie: the threshold never falls below the k-th score, the smallest ids win.
    same = H.Shard(np.arange(100)[::-1].copy(), np.zeros(100, np.int64), np.full((100, 3), 9))
    assert H.mine(same, -1, 0, np.array([1, 1, 1]), [H.Best(3)], True)[0].ids.tolist() == [0, 1, 2]


def test_threshold_bounds_every_row_not_met():
    rng = np.random.default_rng(2)
    for _ in range(20):
        shard = _shard(rng, int(rng.integers(1, 200)), 5)
        anchor = rng.integers(-200, 200, 5) * (rng.random(5) < 0.7)
        left = set(range(len(shard.ids)))
        for rows, scores, threshold in shard.access(anchor):
            assert (scores == shard.x[rows] @ anchor).all()
            left -= set(rows.tolist())
            if anchor.any():
                assert all(int(shard.x[i] @ anchor) <= threshold for i in left)
        assert not left


def test_large_components_are_exact():
    x = np.array([[H.LARGEST, H.LARGEST - 1], [H.LARGEST - 1, H.LARGEST]])
    shard = H.Shard(np.arange(2), np.zeros(2, np.int64), x)
    anchor = np.array([H.LARGEST, H.LARGEST - 3])
    got = H.mine(shard, -1, 0, anchor, [H.Best(2)], True)[0]
    assert got.scores.tolist() == sorted((x @ anchor).tolist(), reverse=True)
