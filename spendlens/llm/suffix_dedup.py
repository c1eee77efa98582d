"""Suffix-array dedup of bytes with longest-previous-factor arrays.

A shard holds distinct segments that share a minimizer, those with copies twice (see
``repeats``). Its suffixes are put into order by prefix doubling, whose ranks also give the
common prefix of any two of them. The previous and the next smaller position in suffix
order are the earlier positions that can share the longest factor with a suffix; the longer
of the two common prefixes is its longest previous factor. One of at least the window marks
a later copy, and its source the first one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import mix64, to_bytes
from spendlens.llm.repeats import Units, covered, with_repeats

GRAM = 24
KEPT_TYPE = "struct<text:binary,n_bytes:bigint,n_removed:bigint,n_spans:bigint>"
_K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _eights(raw) -> np.ndarray:
    """The eight bytes from each position, big-endian."""
    n = len(raw) - 7
    return np.ndarray((n,), ">u8", raw, strides=(1,)).astype(np.uint64)


def _rot(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def byte_grams(raw: bytes) -> np.ndarray:
    n = len(raw) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    w = _eights(raw)
    return mix64((w[:n] * _K[0]) ^ _rot(w[8:8 + n] * _K[1], 23) ^ _rot(w[16:16 + n] * _K[2], 41))


def cut_bytes(raw: bytes, starts: list, ends: list) -> list:
    return [raw[a:b] for a, b in zip(starts, ends, strict=True)]


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, keys in order). Keys with room for a position beside them are sorted by value."""
    bits = max(1, len(key) - 1).bit_length()
    if len(key) and int(key.max()).bit_length() + bits < 64:
        both = key.astype(np.int64) << bits | np.arange(len(key))
        both.sort()
        return both & ((1 << bits) - 1), both >> bits
    order = np.argsort(key)
    return order, key[order]


def _heads(x: np.ndarray) -> np.ndarray:
    """True where a sorted array has a new value."""
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return new


def _ranks(key: np.ndarray) -> np.ndarray:
    order, in_order = _sorted(key)
    new = np.empty(len(key), np.int64)
    new[order] = np.cumsum(_heads(in_order))
    return new


def suffix_levels(key: np.ndarray, rest: np.ndarray, depth: int):
    """Ranks of all positions by their first ``depth`` units, whose order ``key`` has, then by
    twice as many, and so on to whole suffixes; ``rest`` is how far each segment goes on.

    A rank is one more than the number of smaller positions, so a position alone in its rank
    keeps it, and only the others are sorted again. The array is changed in place.
    """
    n = len(key)
    order, key = _sorted(key)
    new = _heads(key)
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first + 1, np.diff(np.append(first, n)))
    tied = np.sort(order[~(new & np.append(new[1:], True))])
    yield rank
    while len(tied):
        after = np.where(rest[tied] > depth, rank[np.minimum(tied + depth, n - 1)], 0)
        order, key = _sorted(rank[tied] * np.int64(n + 1) + after)
        new, group = _heads(key), key // np.int64(n + 1)
        old = np.flatnonzero(_heads(group))
        first = np.flatnonzero(new)
        if len(first) == len(old):  # ranks that stay apart as before stay so for good
            return
        at = tied[order]
        base = np.repeat(old, np.diff(np.append(old, len(at))))
        rank[at] = group - base + np.repeat(first, np.diff(np.append(first, len(at))))
        tied = np.sort(at[~(new & np.append(new[1:], True))])
        yield rank
        depth *= 2


class Suffixes:
    """Suffix order of several strings, each ending where its segment ends. The strings of
    ``many`` are laid down a second time behind the others.

    ``levels[k]`` ranks all positions by their first ``8 << k`` bytes (fewer at the end of a
    segment, and the end sorts first); the last level ranks whole suffixes. Second copies have
    the ranks of the first.
    """

    def __init__(self, data: np.ndarray, sizes: np.ndarray, many: np.ndarray | None = None):
        n = len(data)
        rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        past = ((8 - np.minimum(rest, 8)) * 8).astype(np.uint64)
        head = (_eights(padded.tobytes())[:n] >> past) << past
        key = head
        if not data.all():  # a zero byte is not the end
            key = _ranks(head) * np.int64(9) + np.minimum(rest, 8)
        levels = [rank.astype(np.int32) for rank in suffix_levels(key, rest, 8)]
        again = np.repeat(np.zeros(len(sizes), bool) if many is None else many, sizes)
        self.levels = [np.concatenate((x, x[again])) for x in levels]
        self.head, self.rest = (np.concatenate((x, x[again])) for x in (head, rest))
        self.n = len(self.rest)

    def order(self, starts: np.ndarray) -> np.ndarray:
        """``starts`` by suffix, equal suffixes by position."""
        key = self.levels[-1][starts].astype(np.int64) * np.int64(self.n + 1) + starts
        key.sort()
        return key % np.int64(self.n + 1)

    def common_prefix(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at x and y, pair by pair."""
        most = np.minimum(self.rest[x], self.rest[y])
        whole = self.levels[-1][x] == self.levels[-1][y]
        length = np.where(whole, most, 0)
        for k in range(len(self.levels) - 2, -1, -1):
            on = np.flatnonzero(length < most)
            at = length[on]
            same = self.levels[k][x[on] + at] == self.levels[k][y[on] + at]
            length[on[same]] += 8 << k
        on = np.flatnonzero(length < most)
        at = length[on]
        differ = self.head[x[on] + at] ^ self.head[y[on] + at]
        for k in range(1, 8):
            length[on] += differ >> np.uint64(64 - 8 * k) == 0
        return np.minimum(length, most)


def longest_previous_factors(order: np.ndarray, common: np.ndarray, least: int = 1):
    """(length, source) along ``order``: the longest prefix of each suffix that also starts
    at an earlier position, and that position (-1: none of at least ``least``).

    ``common[i]`` is the common prefix of order[i - 1] and order[i]. The nearest smaller
    position on either side is found by jumps over positions that are larger, with the
    smallest common prefix on the way; all suffixes jump at once, and one whose prefix falls
    below ``least`` stops.
    """
    n = len(order)
    length, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    flipped = np.zeros(n, np.int64)
    flipped[1:] = common[:0:-1]
    for at, shared, out in ((order, common, slice(None)), (order[::-1], flipped, slice(None, None, -1))):
        to, shared = np.arange(n) - 1, shared.copy()
        active = np.flatnonzero((to >= 0) & (shared >= least))
        active = active[at[to[active]] > at[active]]
        while len(active):
            over = to[active]
            to[active], shared[active] = to[over], np.minimum(shared[active], shared[over])
            active = active[(to[active] >= 0) & (shared[active] >= least)]
            active = active[at[to[active]] > at[active]]
        good = (to >= 0) & (shared >= least)
        better = np.flatnonzero(good & (shared > length[out]))
        length[out][better], source[out][better] = shared[better], at[to[better]]
    return length, source


def lpf_index(window: int):
    def search(segments: list, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, segments), np.int64, len(segments))
        data = np.frombuffer(b"".join(segments), np.uint8)
        suffixes = Suffixes(data, sizes, many)
        order = suffixes.order(np.flatnonzero(suffixes.rest >= window))
        common = np.zeros(len(order), np.int64)
        common[1:] = suffixes.common_prefix(order[:-1], order[1:])
        length, source = longest_previous_factors(order, common, window)
        later = length >= window
        found = np.zeros(suffixes.n, bool)
        found[order[later]] = found[source[later]] = True
        hit = np.flatnonzero(found[:len(data)])  # second copies have no documents
        begin = np.cumsum(sizes) - sizes
        seg = np.searchsorted(begin, hit, "right") - 1
        return seg, hit - begin[seg]
    return search


def byte_units(window: int) -> Units:
    return Units(window, GRAM, byte_grams, cut_bytes)


def keep_udf(window: int):
    @F.arrow_udf(KEPT_TYPE)
    def keep(texts: pa.Array, dups: pa.Array) -> pa.Array:
        out, n_bytes, removed, spans = [], [], [], []
        for raw, (a, b) in zip(to_bytes(texts), covered(dups, window), strict=True):
            raw = raw or b""
            n_bytes.append(len(raw))
            removed.append(int((b - a).sum()))
            spans.append(len(a))
            if len(a):
                cuts = [0, *np.stack((a, b), 1).ravel().tolist(), len(raw)]
                raw = b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True))
            out.append(raw)
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.binary()), *[pa.array(x, pa.int64()) for x in (n_bytes, removed, spans)]],
            ["text", "n_bytes", "n_removed", "n_spans"])
    return keep


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                window: int = 200, shard_bytes: int = 1 << 18,
                group_bytes: int = 1 << 21) -> DataFrame:
    """One row per row of ``docs``: its columns as struct ``row``, and struct ``kept``
    (text as bytes, n_bytes, n_removed, n_spans).

    Every byte covered by a ``window``-byte string that also starts anywhere else (another
    document, a repeated row, or the same document) is removed: the longest previous
    factors mark the later copies and their sources the first. Strings are judged on the
    input; matches never cross documents. Null and short texts have nothing to remove (null
    counts as empty). What is left may end inside a character, so it stays bytes. Rows with
    null or equal ids are told apart by their text; equal rows are copies of each other.
    """
    units = byte_units(window)
    found = with_repeats(docs, id_col, text_col, units, lpf_index(window), shard_bytes, group_bytes)
    return found.select("row", keep_udf(window)("t", "dups").alias("kept"))
