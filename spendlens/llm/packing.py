"""Packing of tokenised documents by non-negative least squares on the length histogram.

Documents are cut into full windows and one remainder. The histogram of remainders (at most
one number per length, whatever the corpus) is all the driver sees. It enumerates the
combinations of up to three lengths that fill a window, solves their repeat counts by
non-negative least squares, rounds, and packs the residual greedily. The plan is a short
list of rank ranges per length; every remainder finds its place from its rank among the
remainders of its length, which is a salted running count over slim rows.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import bounded_batches, held, list_array, release, to_bytes, write_table

END_ID = 1
PIECE = "array<struct<start:bigint,length:int,sequence_id:bigint,offset:int>>"


class TokenIds(dict):
    """White-space-free chunk -> its token ids as bytes; emptied when it has grown large.

    The tokenizer drops white space and ends its words there, so a text's ids are its
    chunks' ids in order. Runs of lower-case letters go straight to the tokenizer's model
    (its normaliser and splitter leave them alone), and sentence punctuation behind letters
    is a word of its own; whatever else a chunk holds is encoded as a whole. ``_probe`` makes
    sure that the tokenizer at hand does work like that; with any other every chunk, or
    every whole text, takes the general way.
    """

    LIMIT = 300_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.code, self.width = ("H", 2) if self.tokenizer.get_vocab_size() <= 1 << 16 else ("I", 4)
        self.end = self._pack([END_ID])
        self.by_chunk = self._whole("a bc, d") == self._whole("a") + self._whole("bc,") + self._whole("d")
        self.direct = False
        self.direct = self.by_chunk and all(
            self._letters(w.encode()) == self._whole(w) for w in ("a", "the", "packing", "été", "größe", "señor")
        ) and self._whole("word.,") == self._whole("word") + self._whole(".,")

    def _pack(self, ids: list) -> bytes:
        return array(self.code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: bytes) -> bytes:
        text = word.decode("latin-1")
        return self._pack([t.id for t in self.model.tokenize(text if word.isascii() else text.translate(BYTE_CHARS))])

    def _word(self, chunk: bytes) -> bytes | None:
        """The lower-case letters that the normaliser makes of a chunk; None where it has others."""
        if chunk.isascii():
            return chunk if chunk.isalpha() and chunk.islower() else None
        text = chunk.decode("utf-8", "replace")
        low = text if text.islower() or "\u03a3" in text else text.lower()  # a capital sigma's depends on its place
        if LETTERS.fullmatch(low) is None or not unicodedata.is_normalized("NFC", text):
            return None
        return chunk if low is text else low.encode()

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= self.LIMIT:
            self.clear()
        word = self._word(chunk) if self.direct else None
        if word is not None:
            ids = self._letters(word) if word is chunk else self[word]
        else:
            stem = chunk.rstrip(b".,;:!?*#$%&)]}|>_-\"")
            if self.direct and stem != chunk and self._word(stem) is not None:
                ids = self[stem] + self[chunk[len(stem):]]
            else:
                ids = self._whole(chunk.decode("utf-8", "replace"))
        self[chunk] = ids
        return ids

    def of(self, raw: bytes | None) -> bytes:
        """All ids of a text and the end id."""
        if not raw:
            return self.end
        if not self.by_chunk:
            return self._whole(raw.decode("utf-8", "replace")) + self.end
        fold = self.direct and b"<|" not in raw  # special tokens are left alone
        if fold and (raw.isascii() or not (b"\xcc" in raw or b"\xcd" in raw)):  # no mark composes with a letter
            raw, fold = raw.lower(), False
        chunks = raw.split()
        if fold:
            # The normaliser composes before it lower-cases: a capital keeps its case until
            # the tokenizer has composed it with its mark.
            chunks = [c.lower() if c.isascii() else c for c in chunks]
        return b"".join(map(self.__getitem__, chunks)) + self.end


#: Lower-case letters that case folding leaves alone.
LETTERS = regex.compile(r"\p{Ll}+")


def _byte_chars() -> dict[int, str]:
    """The printable stand-ins of byte-level tokenizers: a visible Latin-1 character stands
    for its own byte, the others follow from U+0100 in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return {b: chr(b if b in visible else next(spare)) for b in range(256)}


BYTE_CHARS = _byte_chars()


def token_ids(path: str) -> TokenIds:
    return held(("tokenizer", path), lambda: TokenIds(path))


def tokens_udf(path: str):
    """The ids of each text as little-endian numbers of the width the vocabulary needs."""
    @F.arrow_udf("binary")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ids = token_ids(path)
        for texts in batches:
            yield pa.array([ids.of(raw) for raw in to_bytes(texts)], pa.binary())
        ids.clear()  # the worker goes on to other stages
    return tokens


def pieces_udf(width: int):
    """The ids of each placed piece as little-endian 32-bit numbers."""
    @F.arrow_udf("array<binary>")
    def pieces(tokens: pa.Array, placed: pa.Array) -> pa.Array:
        release()  # the tokenizer that an earlier stage left in this worker
        flat = placed.flatten()
        starts = flat.field("start").to_numpy(zero_copy_only=False)
        ends = starts + flat.field("length").to_numpy(zero_copy_only=False)
        counts = placed.value_lengths().to_numpy(zero_copy_only=False)
        out, at = [], 0
        for raw, n in zip(tokens.to_pylist(), counts.tolist(), strict=True):
            ids = np.frombuffer(raw, f"<u{width}").astype("<u4")
            out.extend(ids[a:b].tobytes() for a, b in zip(
                starts[at:at + n].tolist(), ends[at:at + n].tolist(), strict=True))
            at += n
        return list_array(pa.array(out, pa.binary()), counts)
    return pieces


def combinations_filling(window: int, present: np.ndarray) -> np.ndarray:
    """(n, 3) lengths a >= b >= c >= 0 with a + b + c = window, all present (0 is no piece).
    Depth one is a whole window, which is cut off before."""
    out = []
    for c in range(window // 3 + 1):
        b = np.arange(max(1, c), (window - c) // 2 + 1)
        out.append(np.stack((window - c - b, b, np.full(len(b), c)), 1))
    all_ = np.concatenate(out)
    have = np.append([True], present[1:] > 0)
    return all_[have[all_].all(1)]


def non_negative_least_squares(combos: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 that minimises |A x - target|^2 (weighted), A counting the lengths of each combination,
    by accelerated projected gradient. Squares are weighted by 1/sqrt(target), so rare
    lengths are not lost beside frequent ones."""
    n = len(target)
    weight = np.zeros(n)
    weight[1:] = 1 / np.sqrt(np.maximum(target[1:], 1.0))

    def forward(x):
        out = sum(np.bincount(combos[:, k], x, n) for k in range(3))
        out[0] = 0
        return out

    def back(r):
        r = r * weight
        r[0] = 0
        return r[combos[:, 0]] + r[combos[:, 1]] + r[combos[:, 2]]

    v = np.ones(len(combos))
    for _ in range(12):  # largest eigenvalue, for the step
        v = back(forward(v))
        size = np.linalg.norm(v)
        if size == 0:
            return np.zeros(len(combos))
        v /= size
    step = 1 / (1.05 * size)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(y - step * back(forward(y) - target), 0)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def rounded(combos: np.ndarray, x: np.ndarray, left: np.ndarray) -> list[tuple[tuple, int]]:
    """Whole repeat counts within the histogram ``left`` (reduced in place): rounded down,
    then one more for the largest fractions while pieces are left."""
    plan = []
    whole = np.floor(x + 1e-9)
    fraction = x - whole
    passes = ((np.argsort(-whole, kind="stable")[:int((whole > 0).sum())], whole),
              (np.argsort(-fraction, kind="stable")[:int((fraction > 1e-3).sum())], np.ones(len(x))))
    for order, times in passes:
        for i in order.tolist():
            combo = tuple(int(v) for v in combos[i] if v)
            need = {v: combo.count(v) for v in combo}
            k = min(int(times[i]), *(int(left[v]) // c for v, c in need.items()))
            if k > 0:
                plan.append((combo, k))
                for v, c in need.items():
                    left[v] -= c * k
    return plan


def greedy(left: np.ndarray, window: int) -> list[tuple[tuple, int]]:
    """Best fit by decreasing length for the residual, repeated as long as its pieces
    last. Combinations that leave a gap are not made here; their pieces stay in ``left``."""
    plan = []
    for longest in range(window - 1, 0, -1):
        while left[longest]:
            combo, room = [longest], window - longest
            used = {longest: 1}
            while room:
                fit = np.flatnonzero(left[1:room + 1]) + 1
                fit = [v for v in fit[::-1][:8].tolist() if left[v] > used.get(v, 0)]
                if not fit:
                    break
                combo.append(fit[0])
                used[fit[0]] = used.get(fit[0], 0) + 1
                room -= fit[0]
            if room:
                break
            k = min(int(left[v]) // c for v, c in used.items())
            plan.append((tuple(combo), k))
            for v, c in used.items():
                left[v] -= c * k
    return plan


class Layout:
    """Where the r-th remainder of each length goes."""

    def __init__(self, histogram: np.ndarray, window: int, first_sequence: int):
        left = histogram.astype(np.int64).copy()
        combos = combinations_filling(window, left)
        plan = []
        if len(combos):
            plan = rounded(combos, non_negative_least_squares(combos, left.astype(float)), left)
        plan += greedy(left, window)
        next_rank = np.zeros(window, np.int64)
        rows = []  # length, first rank, first sequence, offset
        sequence = first_sequence
        for combo, k in plan:
            offset = 0
            for v in combo:
                rows.append((v, int(next_rank[v]), sequence, offset))
                next_rank[v] += k
                offset += v
            sequence += k
        # What is left would leave gaps: laid end to end by decreasing length and cut at
        # the windows, so only the very last sequence is short.
        self.window, self.tail_sequence = window, sequence
        self.tail_rank = next_rank
        lengths = np.arange(window)
        self.tail_begin = (left * lengths)[::-1].cumsum()[::-1] - left * lengths
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.length, self.rank, self.sequence, self.offset = table.T
        self.span = np.int64(max(1, int(histogram.max(initial=0)) + 1))
        self.key = self.length * self.span + self.rank
        self.padding = window - int((left * lengths).sum()) % window if left.any() else 0

    def place(self, length: np.ndarray, rank: np.ndarray):
        """(sequence, offset, length of the first part, rest); a piece of the tail that
        crosses a window is cut, its rest opens the next sequence."""
        tail = rank >= self.tail_rank[length]
        at = np.maximum(np.searchsorted(self.key, length * self.span + rank, "right") - 1, 0)
        position = self.tail_begin[length] + (rank - self.tail_rank[length]) * length
        sequence = np.where(tail, self.tail_sequence + position // self.window, 0)
        offset = np.where(tail, position % self.window, 0)
        if len(self.key):
            sequence = np.where(tail, sequence, self.sequence[at] + rank - self.rank[at])
            offset = np.where(tail, offset, self.offset[at])
        first = np.minimum(length, self.window - offset)
        return sequence, offset, first, length - first


def place_udf(layout: Layout):
    @F.arrow_udf(PIECE)
    def place(start: pa.Array, length: pa.Array, rank: pa.Array) -> pa.Array:
        release()
        s, n, r = (x.to_numpy(zero_copy_only=False) for x in (start, length, rank))
        sequence, offset, first, rest = layout.place(n, r)
        two = 1 + (rest > 0)
        which = np.arange(two.sum()) - np.repeat(np.cumsum(two) - two, two)  # 0, or 1 for a rest
        rep = [np.repeat(x, two) for x in (s, first, rest, sequence, offset)]
        again = which == 1
        return list_array(pa.StructArray.from_arrays(
            [pa.array(rep[0] + np.where(again, rep[1], 0)),
             pa.array(np.where(again, rep[2], rep[1]).astype(np.int32)),
             pa.array(rep[3] + which), pa.array(np.where(again, 0, rep[4]).astype(np.int32))],
            ["start", "length", "sequence_id", "offset"]), two)
    return place


def running_rank(rows: DataFrame, key: str, amount: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``name``: sum of ``amount`` over the rows before this one with the same ``key``; and
    the totals per key. A key may hold any share of the rows: running sums are taken in
    salted parts of it (four per shuffle partition), and a part's start is the sum of the
    parts before it."""
    parts = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int"))
    sums = write_table(rows.groupBy(key, "salt").agg(F.sum(amount).alias("s")), "parts")
    before = (sums.withColumn("base", F.coalesce(F.sum("s").over(
        Window.partitionBy(key).orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .select(F.col(key).alias("bkey"), F.col("salt").alias("bsalt"), "base"))
    w = Window.partitionBy(key, "salt").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = (rows.withColumn("own", F.coalesce(F.sum(amount).over(w), F.lit(0)))
              .join(before, (F.col(key) == F.col("bkey")) & (F.col("salt") == F.col("bsalt")))
              .withColumn(name, F.col("own") + F.col("base")).drop("own", "base", "bkey", "bsalt", "salt"))
    return ranked, sums.groupBy(key).agg(F.sum("s").alias("total"))


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         window: int = 2048) -> DataFrame:
    """One row per piece: id, start, length, ids (little-endian 32-bit), doc_tokens,
    sequence_id, offset.

    A document is its token ids and the end id; a null text is an empty one, so every row
    of ``docs`` has a piece. Repeated rows are packed one by one. Sequences hold at most
    ``window`` ids, offsets are gapless from 0, and all sequences but one are full. Other
    columns are not read. An empty table gives no pieces.
    """
    bounded_batches(docs.sparkSession)
    width = token_ids(tokenizer_path).width
    tokens = docs.select(docs[id_col].alias("id"), tokens_udf(tokenizer_path)(docs[text_col]).alias("tokens"))
    # Texts are read and tokenised once; from here on ids are what is kept and moved.
    tokens = write_table(tokens.withColumn("n", F.floor(F.octet_length("tokens") / width))
                         .withColumn("uid", F.monotonically_increasing_id()), "tokens")
    slim = tokens.select("uid", "n")
    full = F.floor(F.col("n") / window).cast("long")
    parts = slim.select("uid", "n", F.explode(F.array(
        F.struct(F.lit(0).cast("long").alias("start"), F.lit(window).alias("length"), full.alias("reps")),
        F.struct((full * window).alias("start"), (F.col("n") % window).cast("int").alias("length"),
                 F.lit(1).cast("long").alias("reps")))).alias("p")).select("uid", "p.*")
    parts = parts.where("reps > 0 and length > 0")
    ranked, totals = running_rank(parts, "length", "reps", ["uid"], "rank")
    histogram = np.zeros(window, np.int64)
    fulls = 0
    for r in totals.collect():  # at most one row per length
        if r["length"] == window:
            fulls = r["total"]
        else:
            histogram[r["length"]] = r["total"]
    layout = Layout(histogram, window, fulls)
    whole = F.transform(F.sequence(F.lit(0).cast("long"), F.col("reps") - 1), lambda j: F.struct(
        (j * window).alias("start"), F.lit(window).alias("length"),
        (F.col("rank") + j).alias("sequence_id"), F.lit(0).alias("offset")))
    whole = ranked.where(F.col("length") == window).select("uid", whole.cast(PIECE).alias("ps"))
    rest = ranked.where(F.col("length") < window).select(
        "uid", place_udf(layout)("start", F.col("length").cast("long"), "rank").alias("ps"))
    placed = write_table(whole.unionByName(rest).groupBy("uid").agg(F.flatten(F.collect_list("ps")).alias("ps")),
                         "placed")
    out = tokens.join(placed, "uid").select("id", F.col("n").alias("doc_tokens"), F.explode(F.arrays_zip(
        F.col("ps"), pieces_udf(width)("tokens", "ps").alias("ids"))).alias("p"))
    return out.select(F.col("id").alias(id_col), "p.ps.start", F.col("p.ps.length").cast("long").alias("length"),
                      "p.ids", "doc_tokens", "p.ps.sequence_id", F.col("p.ps.offset").cast("long").alias("offset"))
