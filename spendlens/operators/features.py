"""Categorical / numeric features and the six-block feature space (FEA-1..6).

Fitted state is a vocabulary table, a vendor table and a few scalars (max-abs, bin edges);
``feature_arrays`` turns any expense rows into one sparse vector per row.

Block order (fixed, as in the reference's feature union): word TF-IDF, item-name TF-IDF,
char TF-IDF, vendor one-hot, max-abs scaled log amount, quantile-bin one-hot. A feature is
named by the 64-bit hash of its block and value, so the space is as large as the fitted
vocabulary and nothing is folded together.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from spendlens.functions.hashes import HashTable
from spendlens.functions.keys import dense_index
from spendlens.operators import parts as PT
from spendlens.operators import tfidf as T
from spendlens.session import bounded_batches, bounded_reads, materialize, write_table

N_BINS = 10
QUANTILES = [i / N_BINS for i in range(N_BINS + 1)]


# ---------------------------------------------------------------- FEA-1 vendor one-hot

def vendor_index(train: DataFrame, col: str = "vendor_id") -> DataFrame:
    """Alphabetical 0-based index of the distinct training vendors (one-hot categories):
    a range sort of the distinct values, so no value is hot."""
    return dense_index(train.select(col).distinct(), [col], "vendor_index")


# ---------------------------------------------------------------- FEA-2 max-abs scaling

def max_abs(train: DataFrame, col: str = "amount_log") -> float:
    v = train.agg(F.max(F.abs(F.col(col))).alias("m")).first()["m"]
    return float(v) if v else 0.0


def scale_max_abs(col: str, m: float) -> F.Column:
    """x / max|x|; a column whose max is 0 is left as is (scale 1)."""
    return F.col(col) / F.lit(m if m else 1.0)


# ---------------------------------------------------------------- FEA-3/4 quantile bins

def exact_quantiles(df: DataFrame, col: str, qs=QUANTILES) -> list[float]:
    """Linear-interpolated percentiles. Equal values are counted first (a hot value is one
    row), the distinct values are range-sorted, and only partition totals and the at most
    ``2 * len(qs)`` wanted values reach the driver."""
    counted = df.groupBy(F.col(col).alias("x")).agg(F.count(F.lit(1)).alias("n"))
    placed = materialize(counted.orderBy("x").withColumn("pid", F.spark_partition_id()))
    totals = sorted((r["pid"], r["s"]) for r in placed.groupBy("pid").agg(F.sum("n").alias("s")).collect())
    n = sum(s for _, s in totals)
    if n == 0:
        return []
    before, running = {}, 0
    for pid, s in totals:
        before[pid] = running
        running += s
    wanted = [(math.floor(q * (n - 1)), math.ceil(q * (n - 1)), q * (n - 1) % 1) for q in qs]
    ranks = sorted({r for lo, hi, _ in wanted for r in (lo, hi)})
    by_part = {}
    for r in ranks:
        by_part.setdefault(max(p for p in before if before[p] <= r), []).append(r)
    w = Window.partitionBy("pid").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    upto = placed.where(F.col("pid").isin(list(by_part))).withColumn("upto", F.sum("n").over(w))
    hit = None
    for pid, own in by_part.items():
        for r in own:
            at = r - before[pid]
            c = (F.col("pid") == pid) & (F.col("upto") > at) & (F.col("upto") - F.col("n") <= at)
            hit = c if hit is None else hit | c
    found = [(before[r["pid"]] + r["upto"] - r["n"], before[r["pid"]] + r["upto"], r["x"])
             for r in upto.where(hit).collect()]
    value = {r: x for r in ranks for lo, hi, x in found if lo <= r < hi}
    return [float(value[lo] + (value[hi] - value[lo]) * t) for lo, hi, t in wanted]


def bin_edges(train: DataFrame, col: str = "amount_log") -> list[float]:
    """Sorted distinct percentile edges (0, 10, ..., 100)."""
    return sorted(set(exact_quantiles(train, col)))


def bin_index(col: str, edges: list[float]) -> F.Column:
    """Left-closed bins over the interior edges; values below/above clamp to the first/last
    bin. With a single distinct edge (constant column) everything is bin 0."""
    interior = edges[1:-1]
    n_bins = max(len(edges) - 1, 1)
    count = F.lit(0)
    for e in interior:
        count = count + F.when(F.col(col) >= F.lit(e), 1).otherwise(0)
    return F.least(count, F.lit(n_bins - 1)).cast("int")


# ---------------------------------------------------------------- FEA-5 feature space

MIN_DF = [b.min_df for b in T.BLOCKS]
VENDOR, AMOUNT, BIN = len(T.BLOCKS), len(T.BLOCKS) + 1, len(T.BLOCKS) + 2
ROW_COLUMNS = ["row_id", "text", "item_key", "vendor_id", "amount_log"]
STORED = "terms"  # the counted terms of a row, in place of its text
TERMS = "array<struct<b:int,key:bigint,tf:int>>"
HEAD = len(T.BLOCKS) + len(T.BLOCKS) % 2  # 32-bit numbers before the keys of packed terms
HELD_ENTRIES = 1 << 20  # entries a worker gathers before it sums them
_COLLECTING = threading.Lock()
MAX_HELD_TERMS = T.MAX_HELD_TERMS


def feature_key(block: int, value: bytes) -> int:
    """Signed 64-bit name of a feature."""
    h = xxhash.xxh64_intdigest(value, block)
    return h - 2**64 if h >= 2**63 else h


@lru_cache(maxsize=1 << 16)
def _gram_keys(word: str, least: int, most: int, block: int) -> np.ndarray:
    """The feature keys of a word's n-grams; words come again in other texts."""
    grams = T.grams_of(word, least, most)
    return np.fromiter((xxhash.xxh64_intdigest(g, block) for g in grams), np.uint64, len(grams))


P1, P2, P3, P5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 2870177450012600261))


def _short_keys(size: int, seed: int, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """``xxh64(text[i:i + size], seed)`` for every i of ``at``, under eight bytes each."""
    def turned(h, n):
        return (h << np.uint64(n)) | (h >> np.uint64(64 - n))

    def byte(k):
        return text[at + k].astype(np.uint64)
    h = np.full(len(at), (seed + int(P5) + size) % 2**64, np.uint64)
    whole = size // 4 * 4
    if whole:
        h ^= (byte(0) | byte(1) << np.uint64(8) | byte(2) << np.uint64(16) | byte(3) << np.uint64(24)) * P1
        h = turned(h, 23) * P2 + P3
    for k in range(whole, size):
        h ^= byte(k) * P5
        h = turned(h, 11) * P1
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    return h ^ (h >> np.uint64(32))


def _ascii_grams(words: dict, least: int, most: int, block: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(key, times) of the n-grams of ASCII words, all words of a text at once."""
    padded = np.frombuffer(" ".join(f" {w}" for w in words).encode() + b" ", np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    left = np.repeat(np.cumsum(size), size) - np.arange(len(padded))  # bytes from here to the word's end
    times = np.repeat(np.fromiter(words.values(), np.int32, len(words)), size)
    out = []
    for n in range(least, most + 1):
        at = np.flatnonzero(left >= n)
        out.append((_short_keys(n, block, at, padded), times[at]))
    return out


def _counted_block(text: str | None, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, tf) of one text block of a row. N-grams are summed by their key and not as strings."""
    block = T.BLOCKS[i]
    if block.analyzer == "word":
        own = T.counted_terms(text, block)
        key = np.fromiter((xxhash.xxh64_intdigest(t, i) for t in own), np.uint64, len(own))
        return key.view(np.int64), np.fromiter(own.values(), np.int32, len(own))
    words = T.counted_words(text)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    plain = {w: n for w, n in words.items() if w.isascii()} if block.char_min <= 3 and block.char_max < 8 else {}
    grams = _ascii_grams(plain, block.char_min, block.char_max, i) if plain else []
    for w, n in words.items():
        if w not in plain:
            own = _gram_keys(w, block.char_min, block.char_max, i)
            grams.append((own, np.full(len(own), n, np.int32)))
    key, times = (np.concatenate([g[k] for g in grams]) for k in (0, 1))
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first].view(np.int64), np.add.reduceat(times[order], first, dtype=np.int32)


def _counted(text: str | None, item: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, key, tf) of all three text blocks of a row."""
    by_column = {"text": text, "item_key": item}
    own = [_counted_block(by_column[block.column], i) for i, block in enumerate(T.BLOCKS)]
    return (np.repeat(np.arange(len(own), dtype=np.int32), [len(k) for k, _ in own]),
            np.concatenate([k for k, _ in own]), np.concatenate([t for _, t in own]))


def _packed(row: tuple) -> bytes:
    """A row's counted terms as bytes: how many each block has, the keys, the counts. One value
    a row is moved, written and read without a visit to each term."""
    b, key, tf = row
    return np.bincount(b, minlength=HEAD).astype(np.int32).tobytes() + key.tobytes() + tf.astype(np.int32).tobytes()


def _unpacked(raw: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if raw is None:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int32)
    size = np.frombuffer(raw, np.int32, HEAD)
    n = int(size.sum())
    return (np.repeat(np.arange(HEAD, dtype=np.int32), size), np.frombuffer(raw, np.int64, n, 4 * HEAD),
            np.frombuffer(raw, np.int32, n, 4 * HEAD + 8 * n))


def _lists(rows: list, types: tuple) -> list[pa.ListArray]:
    """One list column per array of the rows' tuples."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r[0]) for r in rows], out=offsets[1:])
    return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, t), *[r[k] for r in rows]])))
            for k, t in enumerate(types)]


def _terms_array(rows: list) -> pa.Array:
    b, key, tf = _lists(rows, (np.int32, np.int64, np.int32))
    return pa.ListArray.from_arrays(b.offsets, pa.StructArray.from_arrays([b.values, key.values, tf.values], ["b", "key", "tf"]))


def in_pieces(batch: pa.RecordBatch, rows: Iterator, cells) -> Iterator[tuple[pa.RecordBatch, list]]:
    """A batch with what was made of each of its rows, some rows at a time: a piece is full at
    ``T.PIECE_ENTRIES`` cells, so memory follows the longest row and not the batch."""
    own, held, first = [], 0, 0
    for i, row in enumerate(rows):
        own.append(row)
        held += cells(row)
        if held >= T.PIECE_ENTRIES or i + 1 == batch.num_rows:
            yield batch.slice(first, len(own)), own
            own, held, first = [], 0, i + 1


def _texts_counted(texts: pa.Array, items: pa.Array) -> Iterator[tuple]:
    return (_counted(t.as_py(), x.as_py()) for t, x in zip(texts, items, strict=True))


def _stored(terms: pa.Array, fields: int = 3) -> Iterator[tuple]:
    """The arrays of each row's packed terms or list of structs; a null is an empty one."""
    if not pa.types.is_list(terms.type):
        return (_unpacked(x.as_py()) for x in terms)
    ends = np.cumsum(terms.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
    flat = terms.flatten()
    own = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(fields)]
    return (tuple(x[lo:hi] for x in own) for lo, hi in zip([0, *ends], ends, strict=False))


def counted_rows(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counted terms of every row, packed."""
    bounded_batches(df.sparkSession)
    rows = df.select(*keep, F.col("text").alias("_text"), F.col("item_key").alias("_item"))
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = _texts_counted(batch.column(n), batch.column(n + 1))
            for part, own in in_pieces(batch, counted, lambda r: len(r[0])):
                yield pa.RecordBatch.from_arrays([*part.columns[:n], pa.array([_packed(r) for r in own], pa.binary())],
                                                 [*keep, STORED])

    return rows.mapInArrow(run, ST.StructType([*rows.schema.fields[:n], ST.StructField(STORED, ST.BinaryType())]))


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its input came in fewer files (a small table): a file of
    one row group is one task, however long its texts take."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def term_store(df: DataFrame, name: str = "term-store") -> DataFrame:
    """The rows with their counted terms instead of their text, written once: whatever is
    fitted or scored on parts of it tokenises nothing any more."""
    keep = [c for c in df.columns if c != "text"]
    bounded_reads(df.sparkSession)
    return write_table(counted_rows(spread(df), keep), name)


def row_columns(df: DataFrame) -> list[str]:
    """The columns features are made of: the text, or the terms counted from it."""
    return [STORED if c == "text" and STORED in df.columns else c for c in ROW_COLUMNS]


def with_terms(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the counted terms of every row as a list of structs."""
    rows = df.select(*keep, STORED) if STORED in df.columns else counted_rows(df, keep)
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own in in_pieces(batch, _stored(batch.column(n)), lambda r: len(r[0])):
                yield pa.RecordBatch.from_arrays([*part.columns[:n], _terms_array(own)], [*keep, STORED])

    return rows.mapInArrow(run, ST.StructType([*rows.schema.fields[:n], ST.StructField(STORED, ST._parse_datatype_string(TERMS))]))


def document_frequencies(df: DataFrame, parts: list[str]) -> DataFrame:
    """(b, key, df): in how many rows of each part a term occurs, all parts in one
    aggregation; ``parts`` are boolean columns of ``df``. Each task sums its own rows first,
    ``HELD_ENTRIES`` entries at a time."""
    bounded_batches(df.sparkSession)
    stored, n = STORED in df.columns, len(parts)
    rows = df.select(*parts, *([STORED] if stored else ["text", "item_key"]))

    def summed(entries: list) -> Iterator[pa.RecordBatch]:
        b, key, member = (np.concatenate([e[k] for e in entries]) for k in range(3))
        for block in range(len(T.BLOCKS)):
            of = b == block
            keys, at = np.unique(key[of], return_inverse=True)
            sums = np.stack([np.bincount(at, (member[of] >> k) & 1, len(keys)) for k in range(n)], 1).astype(np.int64)
            for lo in range(0, len(keys), T.PIECE_ENTRIES):
                some = keys[lo:lo + T.PIECE_ENTRIES]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(some), block, np.int32)), pa.array(some),
                     *[pa.array(sums[lo:lo + len(some), k]) for k in range(n)]], ["b", "key", *[f"n{k}" for k in range(n)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held = [], 0
        for batch in batches:
            member = sum((batch.column(k).fill_null(False).to_numpy(zero_copy_only=False).astype(np.int64) << k
                          for k in range(n)), np.zeros(batch.num_rows, np.int64)).tolist()
            own = _stored(batch.column(n)) if stored else _texts_counted(batch.column(n), batch.column(n + 1))
            for m, (b, key, _) in zip(member, own, strict=True):
                entries.append((b.astype(np.int8), key.copy(), np.full(len(key), m, np.int64)))
                held += len(key)
                if held >= HELD_ENTRIES:
                    yield from summed(entries)
                    entries, held = [], 0
        if entries:
            yield from summed(entries)

    sums = rows.mapInArrow(run, "b int, key bigint, " + ", ".join(f"n{k} bigint" for k in range(n)))
    return (sums.repartition("b", "key").groupBy("b", "key")
            .agg(F.array(*[F.sum(f"n{k}") for k in range(n)]).alias("df")))


@dataclass
class FittedFeatures:
    n_docs: int
    vocab: DataFrame | None = None                     # (b, key, idf)
    vendors: DataFrame | None = None                   # (vendor_id)
    max_abs: float = 0.0
    edges: list = field(default_factory=list)
    held: object = None                                # broadcast (HashTable, idf), if small

    def held_vocabulary(self):
        """The vocabulary as a broadcast of its sorted keys and their weights, only where its counted size is
        within MAX_HELD_TERMS; None beyond that."""
        with _COLLECTING:  # the vocabularies of fits that run side by side reach the driver one by one
            if self.held is None and self.vocab.count() <= MAX_HELD_TERMS:
                own = self.vocab.select("key", "idf").toArrow()
                key, idf = (own.column(i).to_numpy() for i in (0, 1))
                del own
                order = np.argsort(key)
                self.held = self.vocab.sparkSession.sparkContext.broadcast((HashTable(key[order]), idf[order]))
            return self.held

    def release(self) -> None:
        """Let the broadcast go; whoever scores again makes it anew."""
        if self.held is not None:
            self.held.destroy()
            self.held = None


def _vocabulary(rows: DataFrame, n: int, counted: DataFrame | None) -> DataFrame:
    if counted is None:
        counted = (document_frequencies(spread(rows).withColumn("all", F.lit(True)), ["all"])
                   .select("b", "key", F.get("df", F.lit(0)).alias("df")))
    least = F.element_at(F.array(*[F.lit(x) for x in MIN_DF]), F.col("b") + 1)
    return counted.where(F.col("df") >= least).select("b", "key", T.idf(n, F.col("df")).alias("idf"))


def fit_features(train: DataFrame, counted: DataFrame | None = None) -> FittedFeatures:
    """Fit every block on ``train``; ``counted`` (b, key, df) are its document frequencies
    where they are known."""
    rows = train.select(*row_columns(train))
    n = rows.count()
    return FittedFeatures(n, write_table(_vocabulary(rows, n, counted), "vocabulary"),
                          write_table(rows.select("vendor_id").distinct(), "vendors"),
                          max_abs(rows), bin_edges(rows))


def planned_features(train: DataFrame, slim: DataFrame, counted: DataFrame | None = None) -> FittedFeatures:
    """``fit_features`` for a fit on dealt rows, whose parts count their terms themselves: the
    vocabulary and the vendors are plans, which run only where a model is saved. ``slim`` has the
    amounts of the same rows."""
    rows = train.select(*row_columns(train))
    n = slim.count()
    return FittedFeatures(n, _vocabulary(rows, n, counted), rows.select("vendor_id").distinct(), max_abs(slim), bin_edges(slim))


def entry_estimate(df: DataFrame) -> F.Column:
    """About how many entries a row has: one a character, or one for 12 bytes of packed terms."""
    return (F.length(STORED) / 12 if STORED in df.columns else F.length("text")).cast("double")


def part_count(slim: DataFrame, entries: str) -> int:
    """Into how many parts these rows go, as many for every core. Only sizes follow it."""
    total = slim.agg(F.sum(entries).alias("n")).first()["n"] or 0.0
    cores = slim.sparkSession.sparkContext.defaultParallelism
    return cores * max(1, math.ceil(total / PT.PART_ENTRIES / cores))


def feature_rows(ff: FittedFeatures, df: DataFrame, keep: list[str]) -> RDD:
    """(kept values, block, key, value) of every row: its counted terms and, as they are, vendor,
    scaled amount and bin."""
    bounded_reads(df.sparkSession)
    stored, n = STORED in df.columns, len(keep)
    rows = spread(df).select(
        *[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col("vendor_id").alias("_vendor"),
        scale_max_abs("amount_log", ff.max_abs).cast("double").alias("_amount"), bin_index("amount_log", ff.edges).alias("_bin"),
        *[F.col(c).alias(f"t{i}") for i, c in enumerate([STORED] if stored else ["text", "item_key"])])

    def run(own: Iterator) -> Iterator[tuple]:
        for r in own:
            r = tuple(r)
            vendor, amount, bin_, *texts = r[n:]
            b, key, value = _unpacked(texts[0]) if stored else _counted(*texts)
            more = [(BIN, b"%d" % bin_, 1.0)]
            if vendor is not None:
                more.append((VENDOR, vendor.encode(), 1.0))
            if amount:
                more.append((AMOUNT, b"", amount))
            yield (r[:n], np.concatenate((b, [m[0] for m in more])).astype(np.int8),
                   np.concatenate((key, np.array([feature_key(m[0], m[1]) for m in more], np.int64))),
                   np.concatenate((value, [m[2] for m in more])).astype(np.float32))
    return rows.rdd.mapPartitions(run)


def in_order(b: np.ndarray, key: np.ndarray, value: np.ndarray) -> tuple:
    """A row's entries by ascending key."""
    order = np.argsort(key)
    return b[order], key[order], value[order]


def _row_vector(b, key, w, vendor, amount, bin_):
    """All six blocks of one row: text weights normalised per block and the others between
    them; ``key`` ascends."""
    norm = np.sqrt(np.bincount(b, w * w, len(T.BLOCKS)))
    more = [(feature_key(BIN, b"%d" % bin_), 1.0)]
    if vendor is not None:
        more.append((feature_key(VENDOR, vendor.encode()), 1.0))
    if amount:
        more.append((feature_key(AMOUNT, b""), amount))
    more.sort()
    extra = np.array([m[0] for m in more], np.int64)
    at = np.searchsorted(key, extra)
    return np.insert(key, at, extra), np.insert(w / norm[b], at, [m[1] for m in more])


def _held_vectors(terms: Iterator, table: HashTable, idf: np.ndarray, others: Iterator) -> Iterator[tuple]:
    """Row vectors from counted terms, with the vocabulary at hand."""
    for (b, key, tf), other in zip(terms, others, strict=True):
        b, key, tf = in_order(b, key, tf)  # ascending keys are found several times faster
        at, hit = table.find(key)
        yield _row_vector(b[hit], key[hit], (1 + np.log(tf[hit])) * idf[at[hit]], *other)


def map_vectors(ff: FittedFeatures, df: DataFrame, keep: list[str], work, schema: str) -> DataFrame:
    """``work(kept, rows)`` on every row of ``df``, some rows at a time: a struct array of the
    ``keep`` columns and each row's (idx, val), all six blocks, idx ascending. It gives a
    record batch of ``schema`` behind which the struct ``keep`` stands first. Null, repeated
    and missing ids lose or merge nothing.

    A vocabulary of counted bounded size is broadcast and the rows are mapped in place.
    Beyond the bound terms meet the vocabulary by a join on their key and come back to rows
    of the same content (a 128-bit hash); equal rows have equal entries, which a set
    collapses. Both ways give the same vectors.
    """
    bounded_batches(df.sparkSession)
    scaled = scale_max_abs("amount_log", ff.max_abs).cast("double").alias("_amount")
    bin_ = bin_index("amount_log", ff.edges).alias("_bin")
    known = ff.vendors.select(F.col("vendor_id").alias("known"))
    own = row_columns(df)[1:]
    if (held := ff.held_vocabulary()) is not None:
        stored = STORED in df.columns
        names = [STORED] if stored else ["text", "item_key"]
        rows = spread(df).select(F.struct(*keep).alias("keep"), *[F.col(c) for c in own]).join(
            known, F.col("vendor_id") == F.col("known"), "left")
    else:
        stored, names = True, ["e"]
        content = [F.col(c) if c == STORED else F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in own]
        base = df.select(F.struct(*keep).alias("keep"), *[F.col(c) for c in own],
                         F.xxhash64(*content).alias("h1"), F.xxhash64(F.lit(1), *content).alias("h2"))
        terms = with_terms(base, ["h1", "h2"]).select("h1", "h2", F.explode(STORED).alias("t")).select("h1", "h2", "t.*")
        entries = (terms.join(ff.vocab, ["b", "key"])
                   .select("h1", "h2", F.struct("b", "key", ((1 + F.log("tf")) * F.col("idf")).alias("w")).alias("e"))
                   .groupBy("h1", "h2").agg(F.collect_set("e").alias("e")))
        rows = base.drop("text", STORED, "item_key").join(entries, ["h1", "h2"], "left").join(
            known, F.col("vendor_id") == F.col("known"), "left")
    ready = rows.select("keep", "known", scaled, bin_, *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            found = _stored(batch.column(4)) if stored else _texts_counted(batch.column(4), batch.column(5))
            vectors = (_held_vectors(found, *held.value, others) if held is not None
                       else (_row_vector(*in_order(*e), *o) for e, o in zip(found, others, strict=True)))
            for part, rows in in_pieces(batch, vectors, lambda r: len(r[0])):
                yield work(part.column(0), rows)

    out = ST.StructType([ready.schema["keep"], *ST._parse_datatype_string(schema).fields])
    return ready.mapInArrow(run, out)


def feature_arrays(ff: FittedFeatures, df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and one sparse row as two aligned arrays ``idx`` and ``val`` for every row of ``df``."""
    def work(kept: pa.Array, rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([kept, *_lists(rows, (np.int64, np.float64))], ["keep", "idx", "val"])
    return map_vectors(ff, df, keep, work, "idx array<bigint>, val array<double>").select("keep.*", "idx", "val")
