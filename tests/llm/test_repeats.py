import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spendlens.llm import repeats, substring_dedup, suffix_dedup
from tests.llm.fixtures import WORD, corpus, frame, repeated_units


def _key(x):
    return (x[0] is None, x)


def _expected_bytes(rows, window):
    texts = [(t or "").encode() for _, t, _ in rows]
    out = []
    for (i, _, _), raw, hit in zip(rows, texts, repeated_units(texts, list, window), strict=True):
        spans = sum(1 for j, h in enumerate(hit) if h and (j == 0 or not hit[j - 1]))
        out.append((i, len(raw), sum(hit), spans, bytes(b for b, h in zip(raw, hit, strict=True) if not h)))
    return sorted(out, key=_key)


def _expected_words(rows, window):
    texts = [WORD.findall(t or "") for _, t, _ in rows]
    return sorted(((i, len(w), sum(h), " ".join(x for x, y in zip(w, h, strict=True) if not y))
                   for (i, _, _), w, h in zip(rows, texts, repeated_units(texts, list, window), strict=True)), key=_key)


@pytest.mark.parametrize("group", [1 << 20, 300])
def test_bytes_against_brute_force(spark, group):
    rows = [r for r in corpus() if len(r[1] or "") < 20_000]
    out = suffix_dedup.dedup_bytes(frame(spark, rows), window=60, shard_bytes=4000, group_bytes=group)
    assert out.select("row.*").columns[-1] == "n_words"
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.text))
           for r in out.select("row.doc_id", "kept.*").collect()]
    assert sorted(got, key=_key) == _expected_bytes(rows, 60)


@pytest.mark.parametrize("group", [1 << 20, 60])
def test_words_against_brute_force(spark, group):
    rows = corpus()
    out = substring_dedup.dedup_substrings(frame(spark, rows), window=15, shard_words=500, group_words=group)
    got = [(r.doc_id, r.kept.n_words, r.kept.n_removed, r.kept.text) for r in out.select("row.doc_id", "kept").collect()]
    assert sorted(got, key=_key) == _expected_words(rows, 15)


def test_empty_table(spark):
    for f in (suffix_dedup.dedup_bytes, substring_dedup.dedup_substrings):
        assert f(frame(spark, [])).collect() == []


def test_null_and_empty_have_nothing_to_remove(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, None, "en")]
    got = substring_dedup.dedup_substrings(frame(spark, rows)).select("kept.*").collect()
    assert {tuple(r) for r in got} == {("", 0, 0)} and len(got) == 3


@given(st.lists(st.integers(1, 4), min_size=2, max_size=120), st.integers(2, 9))
@settings(max_examples=60, deadline=None)
def test_matching_statistics(words, limit):
    text = np.array([*words, 0], np.int64)
    ends = np.arange(len(words))
    got = substring_dedup.FMIndex(text).matching_statistics(text, ends, limit)
    for e in ends.tolist():
        best = 0
        for n in range(1, min(limit, e + 1) + 1):
            part = words[e - n + 1:e + 1]
            if sum(words[i:i + n] == part for i in range(len(words) - n + 1)) >= 2:
                best = n
        assert got[e] == best


@given(st.lists(st.binary(min_size=20, max_size=60), min_size=1, max_size=6), st.integers(8, 20), st.integers(0, 63))
@settings(max_examples=60, deadline=None)
def test_indexes_find_the_repeated_windows(parts, window, copied):
    parts = [bytes(b & 1 for b in p) for p in parts]
    many = np.array([copied >> i & 1 == 1 for i in range(len(parts))])
    at = {(i, j): p[j:j + window] for i, p in enumerate(parts) for j in range(len(p) - window + 1)}
    expected = sorted(k for k, v in at.items() if many[k[0]] or list(at.values()).count(v) > 1)
    seg, off = suffix_dedup.lpf_index(window)(parts, many)
    assert list(zip(seg.tolist(), off.tolist(), strict=True)) == expected
    words = [b" ".join(b"%d" % b for b in p) for p in parts]
    seg, off = substring_dedup.fm_index(window)(words, many)
    assert list(zip(seg.tolist(), off.tolist(), strict=True)) == expected


def _prefix(x, y):
    n = 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    return n


@given(st.lists(st.binary(min_size=1, max_size=70), min_size=1, max_size=5), st.integers(1, 3))
@settings(max_examples=100, deadline=None)
def test_longest_previous_factors(parts, letters):
    parts = [bytes(b % letters for b in p) for p in parts]
    tails = [p[j:] for p in parts for j in range(len(p))]
    suffixes = suffix_dedup.Suffixes(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]))
    order = suffixes.order(np.arange(len(tails)))
    assert order.tolist() == sorted(range(len(tails)), key=lambda i: (tails[i], i))
    common = np.zeros(len(tails), np.int64)
    common[1:] = suffixes.common_prefix(order[:-1], order[1:])
    assert common[1:].tolist() == [_prefix(tails[a], tails[b]) for a, b in zip(order, order[1:])]
    length, source = suffix_dedup.longest_previous_factors(order, common)
    for i, n, s in zip(order.tolist(), length.tolist(), source.tolist(), strict=True):
        assert n == max((_prefix(tails[i], tails[j]) for j in range(i)), default=0)
        assert (s == -1) if n == 0 else (s < i and _prefix(tails[i], tails[s]) == n)


def test_long_texts(spark):
    """Texts of over 100,000 bytes: plain ones, a constant one, a periodic one, and a copy inside another."""
    rng = np.random.default_rng(5)
    letters = np.frombuffer(b"abcdefghijklmnop ", np.uint8)
    a, b = (bytes(rng.choice(letters, 150_000)).decode() for _ in range(2))
    rows = [(1, a, "en"), (2, b[:70_000] + a[40_000:90_000] + b[70_000:], "en"),
            (3, "x" * 120_000, "en"), (4, "0123456789" * 12_000, "en")]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.dedup_bytes(
        frame(spark, rows), group_bytes=1 << 20).select("row.doc_id", "kept.*").collect()}
    assert got == {1: (150_000, 50_000, 1), 2: (200_000, 50_000, 1),
                   3: (120_000, 120_000, 1), 4: (120_000, 120_000, 1)}


@given(st.lists(st.integers(0, 3), min_size=12, max_size=200), st.integers(3, 8))
@settings(max_examples=60, deadline=None)
def test_equal_windows_share_a_minimizer_and_all_windows_are_in_a_segment(values, span):
    g = (np.array(values, np.uint64) + np.uint64(5)) * np.uint64(0x9E3779B97F4A7C15)
    starts, nwin, mini, _ = repeats.segments(g, span)
    assert nwin.sum() == len(g) - span + 1 and (starts[1:] == np.cumsum(nwin)[:-1]).all()
    of = np.repeat(mini, nwin)
    assert all(of[j] == g[j:j + span].min() for j in range(len(of)))
    grams = repeats.minimizer_grams(g, span)
    positions = {j + k for j in range(len(of)) for k in range(span) if g[j + k] == of[j]}
    assert len(grams) == len(positions)


def test_parts_of_a_shard_share_no_minimizer():
    rng = np.random.default_rng(8)
    for n, kinds, most in ((0, 1, 5), (1, 1, 5), (200, 30, 100), (200, 1, 10), (500, 400, 1)):
        mini, width = rng.integers(-kinds, kinds, n), rng.integers(1, 20, n)
        parts = list(repeats.shard_parts(mini, width, most))
        assert sorted(np.concatenate(parts).tolist()) == list(range(n))
        owners = [set(mini[p].tolist()) for p in parts]
        assert sum(map(len, owners)) == len(set(mini.tolist()))
        assert all(width[p].sum() <= most or len(o) <= 1 for p, o in zip(parts, owners, strict=True))


def test_a_shard_in_parts_gives_the_same_repeats(spark, monkeypatch):
    rows = corpus()

    def got():
        out = suffix_dedup.dedup_bytes(frame(spark, rows), shard_bytes=1 << 30)
        return sorted(((r.doc_id, r.kept.n_removed, bytes(r.kept.text)) for r in out.select("row.doc_id", "kept").collect()),
                      key=repr)
    whole = got()
    assert any(n for _, n, _ in whole)
    monkeypatch.setattr(repeats, "PART_BYTES", 1)
    assert got() == whole
