"""Substring dedup of word sequences with a compressed FM-index per shard.

A shard holds distinct segments that share a minimizer, those with copies twice (see
``repeats``). Its words are numbered, the Burrows-Wheeler transform of all its segments is kept in a wavelet matrix of
bit vectors with sampled counts, and the documents' segments are streamed against it:
backward search extends every window end to the left while the match still has two
occurrences. The lengths reached are the matching statistics; those that reach the window
length are reported as intervals.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import mix64, to_bytes
from spendlens.llm.repeats import Units, covered, with_repeats
from spendlens.llm.suffix_dedup import suffix_levels

GRAM = 8
KEPT_TYPE = "struct<text:string,n_words:bigint,n_removed:bigint>"
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


class _Hashes(dict):
    """Word -> 64-bit hash; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _Hashes()


def word_grams(raw: bytes) -> np.ndarray:
    words = raw.split()
    n = len(words) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    out = h[:n].copy()
    for k in range(1, GRAM):
        out *= _FACTOR
        out += h[k:k + n]
    return mix64(out)


def cut_words(raw: bytes, starts: list, ends: list) -> list:
    words = raw.split()
    return [b" ".join(words[a:b]) for a, b in zip(starts, ends, strict=True)]


_LOWER_BITS = (np.uint64(1) << np.arange(64, dtype=np.uint64)) - np.uint64(1)


class Bits:
    """A bit vector with counts sampled every 64 bits."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.append(bits, np.zeros(-len(bits) % 64 + 64, bool)), bitorder="little")
        self.words = packed.view(np.uint64)
        self.before = np.zeros(len(self.words), np.int64)
        np.cumsum(np.bitwise_count(self.words[:-1]), out=self.before[1:])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before position i."""
        at = i >> 6
        return self.before[at] + np.bitwise_count(self.words[at] & _LOWER_BITS[i & 63])


class FMIndex:
    """FM-index of a sequence of small non-negative numbers, in a wavelet matrix."""

    def __init__(self, text: np.ndarray):
        """``text`` is one or more segments, each with a zero at its end."""
        n = len(text)
        ends = np.flatnonzero(text == 0)
        rest = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n) + 1
        for rank in suffix_levels(text, rest, 1):
            pass
        # suffixes that are equal to their ends go by position, as if each end were its own symbol
        order = np.sort(rank * np.int64(n + 1) + np.arange(n)) % np.int64(n + 1)
        level = text[order - 1]
        counts = np.bincount(text)
        self.first = np.cumsum(counts) - counts
        self.levels = []
        symbols = np.arange(len(counts))
        base = np.zeros(len(counts), np.int64)
        for bit in range(max(1, int(text.max()).bit_length()) - 1, -1, -1):
            ones = (level >> bit) & 1 == 1
            bits, zeros = Bits(ones), int(n - ones.sum())
            r = bits.rank(base)
            base = np.where((symbols >> bit) & 1 == 1, zeros + r, base - r)
            self.levels.append((bit, bits, zeros))
            level = np.concatenate((level[~ones], level[ones]))
        self.base = base  # where each symbol's block starts on the last level
        self.n = n

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        """Ranges of the matches with ``symbol`` put in front."""
        both = np.concatenate((lo, hi))
        two = np.concatenate((symbol, symbol))
        for bit, bits, zeros in self.levels:
            r = bits.rank(both)
            both = np.where((two >> bit) & 1 == 1, zeros + r, both - r)
        both += (self.first - self.base)[two]
        return both[:len(lo)], both[len(lo):]

    def matching_statistics(self, text: np.ndarray, ends: np.ndarray, limit: int,
                            occurrences: int = 2) -> np.ndarray:
        """For each end position the longest match to its left with that many occurrences,
        as far as ``limit``."""
        reached = np.zeros(len(ends), np.int64)
        active, at = np.arange(len(ends)), ends.copy()
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), self.n)
        for _ in range(limit):
            lo, hi = self.extend(text[at], lo, hi)
            on = hi - lo >= occurrences
            active, at, lo, hi = active[on], at[on] - 1, lo[on], hi[on]
            if not len(active):
                break
            reached[active] += 1
        return reached


def fm_index(window: int):
    def search(segments: list, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        number: dict[bytes, int] = {}
        split = [s.split() for s in segments]
        for ws in split:
            ws.append(None)
        # zero ends each segment, and no pattern has it
        text = np.fromiter((number.setdefault(w, len(number) + 1) if w is not None else 0
                            for w in chain.from_iterable(split)), np.int64)
        sizes = np.fromiter(map(len, split), np.int64, len(split)) - 1
        text = np.concatenate((text, text[np.repeat(many, sizes + 1)]))
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        index = FMIndex(text)
        # A match of the last end that goes back n words repeats all windows inside it ...
        back = index.matching_statistics(text, begin + sizes - 1, int(sizes.max()))
        count = sizes - window + 1
        of = np.repeat(np.arange(len(split)), count)
        offset = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        hit = offset >= (sizes - np.minimum(back, sizes))[of]
        # ... and the others are searched one by one.
        rest = np.flatnonzero(~hit)
        if len(rest):
            hit[rest] = index.matching_statistics(
                text, begin[of[rest]] + offset[rest] + window - 1, window) >= window
        return of[hit], offset[hit]
    return search


def word_units(window: int) -> Units:
    return Units(window, GRAM, word_grams, cut_words)


def keep_udf(window: int):
    @F.arrow_udf(KEPT_TYPE)
    def keep(texts: pa.Array, dups: pa.Array) -> pa.Array:
        out, n_words, removed = [], [], []
        for raw, (a, b) in zip(to_bytes(texts), covered(dups, window), strict=True):
            words = (raw or b"").split()
            n_words.append(len(words))
            removed.append(int((b - a).sum()))
            if len(a):
                cuts = [0, *np.stack((a, b), 1).ravel().tolist(), len(words)]
                words = [w for x, y in zip(cuts[::2], cuts[1::2], strict=True) for w in words[x:y]]
            out.append(b" ".join(words))
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_words, pa.int64()),
             pa.array(removed, pa.int64())], ["text", "n_words", "n_removed"])
    return keep


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = 35, shard_words: int = 1 << 17,
                     group_words: int = 1 << 18) -> DataFrame:
    """One row per row of ``docs``: its columns as struct ``row``, and struct ``kept``
    (text, n_words, n_removed).

    Words are runs without white space, unchanged. Every word covered by ``window``
    consecutive words whose sequence also starts anywhere else (another document, a
    repeated row, or the same document) is removed; windows are judged on the input. The
    kept words are joined by one space. Null, empty and short texts have nothing to remove.
    Rows with null or equal ids are told apart by their text; equal rows are copies of
    each other.
    """
    units = word_units(window)
    found = with_repeats(docs, id_col, text_col, units, fm_index(window), shard_words, group_words)
    return found.select("row", keep_udf(window)("t", "dups").alias("kept"))
