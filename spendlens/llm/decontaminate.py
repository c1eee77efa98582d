"""Benchmark decontamination with a generalised suffix automaton.

The test items are the query set: their normalised words are built into a suffix automaton
of all items, and every document is streamed through it, word by word, tracking the longest
suffix that occurs in some item. Documents never move; an item set too large for one
automaton is taken in blocks of at most ``BLOCK_BYTES`` of text, one pass over the
documents each.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import bounded_batches, held, list_array, merged_runs, to_bytes, write_table

BLOCK_BYTES = 1 << 20
SCAN = "struct<n_words:bigint,spans:array<struct<a:int,b:int>>,items:array<string>,cut:string>"
CLEAN = "struct<text:string,n_hit:bigint>"
#: A-Z lower-cased; every other ASCII character but digits and letters is a space.
NORMALISE = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words_of(raw) -> list:
    return (raw or b"").translate(NORMALISE).split()


def word_spans(raw: bytes) -> list[tuple[int, int]]:
    """Byte ranges of the words of ``words_of``."""
    return [m.span() for m in re.finditer(rb"\S+", raw.translate(NORMALISE))]


class Automaton:
    """Generalised suffix automaton over words, with the items of every window."""

    def __init__(self, items: list[tuple[str, list]], width: int):
        self.width = width
        self.number: dict[bytes, int] = {}
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(item, [self.number.setdefault(w, len(self.number) + 1) for w in words])
                 for item, words in items if words]
        for _, codes in coded:
            last = 0
            for c in codes:
                last = self._extend(last, c)
        self.items: dict[int, set] = {}  # state of a window of ``width`` words -> items
        self.short: dict[int, dict] = {}  # state -> {words of a shorter item: items}
        for item, codes in coded:
            if len(codes) >= width:
                for state, _ in self.stream(codes):
                    if (u := self._window_state(state)) is not None:
                        self.items.setdefault(u, set()).add(item)
            else:
                *_, (state, _) = self.stream(codes)
                while self.length[self.link[state]] >= len(codes):
                    state = self.link[state]
                self.short.setdefault(state, {}).setdefault(len(codes), set()).add(item)
        self.up = self._short_links()
        size = np.int64(len(self.number) + 1)
        self.size = size
        self.pairs = np.unique(np.array([a * size + b for _, c in coded for a, b in zip(c, c[1:])], np.int64))
        self.least = min([width, *(len(c) for _, c in coded)])

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if c in nxt[last]:
            q = nxt[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, q, c)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return new

    def _clone(self, p: int, q: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        link[q] = copy
        return copy

    def _window_state(self, state: int) -> int | None:
        if self.length[state] < self.width:
            return None
        while self.length[self.link[state]] >= self.width:
            state = self.link[state]
        return state

    def _short_links(self) -> list:
        """Per state the nearest state on its link path, itself included, that ends a
        shorter item; -1 for none."""
        up = [-1] * len(self.next)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up[s] = s if s in self.short else up[self.link[s]]
        return up

    def stream(self, codes):
        """(state, matched length) after each word."""
        nxt, link, length = self.next, self.link, self.length
        v = n = 0
        for c in codes:
            while v and c not in nxt[v]:
                v = link[v]
                n = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                n += 1
            else:
                n = 0
            yield v, n

    def scan(self, words: list) -> tuple[list, list, set]:
        """(starts, ends, items) of the window occurrences in a document. Only runs in
        which every pair of neighbours is some item's can hold one; only they are streamed."""
        codes = np.fromiter((self.number.get(w, 0) for w in words), np.int64, len(words))
        known = np.zeros(len(codes) + 1, bool)
        pairs = codes[:-1] * self.size + codes[1:]
        maybe = np.flatnonzero((codes[:-1] > 0) & (codes[1:] > 0))
        if len(maybe) and len(self.pairs):
            at = np.searchsorted(self.pairs, pairs[maybe])
            at[at == len(self.pairs)] = 0
            known[maybe[self.pairs[at] == pairs[maybe]] + 1] = True
        begin = np.flatnonzero(~known)  # of runs; the last is the end of the text
        sizes = np.diff(begin)
        use = np.flatnonzero((sizes >= self.least) & (codes[begin[:-1]] > 0)) if len(codes) else []
        starts, ends, items = [], [], set()
        for r in use:
            first = int(begin[r])
            for i, (v, n) in enumerate(self.stream(codes[first:first + int(sizes[r])].tolist()), first + 1):
                if n >= self.width:
                    starts.append(i - n)
                    ends.append(i)
                    # the matched state may be longer than the match: go to the window's own
                    items.update(self.items[self._window_state(v)])
                u = self.up[v]
                while u > 0:
                    for size, own in self.short[u].items():
                        if size <= n:
                            starts.append(i - size)
                            ends.append(i)
                            items.update(own)
                    u = self.up[self.link[u]]
        return starts, ends, items


def without_spans(raw: bytes, starts, ends) -> bytes:
    """The text without the bytes from the first to the last word of each run of words."""
    at = word_spans(raw)
    cuts = [0]
    for a, b in zip(starts, ends, strict=True):
        cuts += [at[a][0], at[b - 1][1]]
    cuts.append(len(raw))
    return b"".join(raw[x:y] for x, y in zip(cuts[::2], cuts[1::2], strict=True))


def scan_udf(items: list, width: int, cut: bool = False):
    """Adds the occurrences of one block of items to what earlier blocks found. With ``cut``
    the text without them comes along (null where nothing is hit), so that one worker does
    both for a task."""
    key = hashlib.sha256(repr((items, width)).encode()).hexdigest()

    @F.arrow_udf(SCAN)
    def scan(texts: pa.Array, spans: pa.Array, found: pa.Array) -> pa.Array:
        sam = held(key, lambda: Automaton([(i, words_of(t)) for i, t in items], width))
        rest: list = []
        n_words, a_all, b_all, counts, names, n_names = [], [], [], [], [], []
        old_spans, old_names = spans.to_pylist(), found.to_pylist()
        for raw, old, had in zip(to_bytes(texts), old_spans, old_names, strict=True):
            words = words_of(raw)
            starts, ends, own = sam.scan(words)
            for x in old:
                starts.append(x["a"])
                ends.append(x["b"])
            a, b = merged_runs(np.array(starts, np.int32), np.array(ends, np.int32))
            own = sorted({*own, *had})
            n_words.append(len(words))
            a_all.append(a)
            b_all.append(b)
            counts.append(len(a))
            names.extend(own)
            n_names.append(len(own))
            rest.append(without_spans(raw, a.tolist(), b.tolist()) if cut and len(a) else None)
        flat = [np.concatenate(x) if x else np.zeros(0, np.int32) for x in (a_all, b_all)]
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()),
             list_array(pa.StructArray.from_arrays([pa.array(x) for x in flat], ["a", "b"]), counts),
             list_array(pa.array(names, pa.string()), n_names), pa.array(rest, pa.binary()).cast(pa.string())],
            ["n_words", "spans", "items", "cut"])
    return scan


def _blocks(bench: DataFrame, id_col: str, text_col: str, block_bytes: int):
    """The items in blocks of about ``block_bytes`` of text, one block on the driver at a time."""
    items = bench.select(F.coalesce(bench[id_col].cast("string"), F.lit("")).alias("i"),
                         bench[text_col].alias("t")).where(F.col("t").isNotNull())
    total = items.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // block_bytes))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(blocks))
    for k in range(blocks):
        rows = items.where(part == k).collect()
        yield k == blocks - 1, sorted((r["i"], r["t"].encode()) for r in rows)


def scan_benchmark(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", width: int = 10,
                   block_bytes: int = BLOCK_BYTES, cut: bool = False) -> DataFrame:
    """One row per row of ``docs``: its columns as struct ``row``, its text ``t``, n_words,
    n_hit, spans (hit runs of words [a, b)), items (sorted distinct ids as strings), and
    with ``cut`` the column cut: the text without its hit runs.

    A word is hit inside any occurrence of ``width`` consecutive words of an item, or of a
    whole shorter item. Null and wordless texts have no words; items without words match
    nothing. Items with a null id share the id ''; repeated items are one item per id. An
    empty benchmark hits nothing. Repeated rows come back one by one.
    """
    bounded_batches(docs.sparkSession)
    state = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("t"),
                        F.array().cast("array<struct<a:int,b:int>>").alias("spans"),
                        F.array().cast("array<string>").alias("items"))
    for last, block in _blocks(bench, item_col, item_text_col, block_bytes):
        state = (state.withColumn("s", scan_udf(block, width, cut and last)("t", "spans", "items"))
                 .select("row", "t", "s.n_words", "s.spans", "s.items",
                         *([F.coalesce("s.cut", "t").alias("cut")] if cut and last else [])))
        if not last:
            state = write_table(state.drop("n_words"), "scanned")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x.b - x.a))
    return state.withColumn("n_hit", hit)


def remove_spans(text: Column, spans: Column) -> Column:
    """The text without the bytes from the first to the last word of each run."""
    @F.arrow_udf("string")
    def remove(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for raw, own in zip(to_bytes(texts), spans.to_pylist(), strict=True):
            if raw is not None and own:
                raw = without_spans(raw, [x["a"] for x in own], [x["b"] for x in own])
            out.append(raw)
        return pa.array(out, pa.binary()).cast(pa.string())
    return remove(text, spans)


def over_limits(max_coverage: float) -> Column:
    """True for documents of which more than ``max_coverage`` of the words are hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") > F.col("n_words") * max_coverage)
