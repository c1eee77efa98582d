"""Routing of repeated windows to index shards by content.

Two operators look for windows of a fixed number of units (words or bytes) that start more
than once in the corpus. An index over all text would fit no machine, and an index per
arbitrary shard would have to be searched with all documents. Here the content decides
the shard: a window belongs to its minimizer, the smallest hash among its grams, so equal
windows always meet.

1. Every document emits the grams that are the minimizer of some window (about one in half
   a window). A gram seen once in the corpus cannot belong to a repeated window.
2. Segments (maximal runs of windows with one minimizer) of the remaining grams are kept
   with a 128-bit key (minimizer, content hash). Equal segments are represented by one of
   them, so a passage in a third of all documents is one row per document and one segment
   in the index.
3. The representatives are cut out of their text and go to the shard of their minimizer,
   where the operator's index finds the windows that occur more than once in it. A segment
   with copies is laid down twice, so the index finds its windows as well; what it finds
   goes back to the copies by the key.
   A minimizer whose distinct segments exceed ``group_units`` (a very common phrase in
   many contexts) is dealt out by window instead of by minimizer, so that no shard grows.

Everything between the steps is a slim table in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlens.llm.common import Scratch, bounded_batches, list_array, merged_runs, mix64, text_hash, to_bytes, write_table

_BASE = 0x9E3779B97F4A7C15 | 1
SEGMENTS = "array<struct<start:int,nwin:int,mini:bigint,sh:bigint>>"
RANGES = "array<struct<a:int,b:int>>"
#: Encoded segments that one index holds at once; those of one minimizer stay together.
PART_BYTES = 1 << 19


@dataclass(frozen=True)
class Units:
    """How a text is read: ``grams(raw)`` are the hashes of all grams of ``gram`` units;
    ``cut(raw, starts, ends)`` are the encoded unit ranges."""
    window: int
    gram: int
    grams: Callable[[bytes], np.ndarray]
    cut: Callable[[bytes, list, list], list]

    @property
    def span(self) -> int:
        """Grams in a window."""
        return self.window - self.gram + 1


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown as needed."""

    def __init__(self):
        self.inverse = pow(_BASE, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", self.inverse)):
                x = np.full(size, np.uint64(base & (2**64 - 1)))
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def sliding(x: np.ndarray, width: int, op=np.minimum) -> np.ndarray:
    """``op`` over every ``width`` consecutive elements, by doubling."""
    size = 1
    while size * 2 <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return op(x[:-rest], x[rest:]) if rest else x


def minimizer_grams(g: np.ndarray, span: int) -> np.ndarray:
    """The grams that are the smallest of some window, each position once."""
    m = sliding(g, span)
    pad = np.zeros(span - 1, np.uint64)
    return g[sliding(np.concatenate((pad, m, pad)), span, np.maximum) == g]


def range_hashes(g: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the gram sequences [start, end)."""
    up, down = _POWERS.get(len(g) + 1)
    sums = np.zeros(len(g) + 1, np.uint64)
    np.cumsum(g * up[:len(g)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def segments(g: np.ndarray, span: int):
    """(start, number of windows, minimizer, content hash) of the runs of windows."""
    m = sliding(g, span)
    starts = np.concatenate(([0], np.flatnonzero(m[1:] != m[:-1]) + 1))
    ends = np.append(starts[1:], len(m))
    return starts, ends - starts, m[starts], range_hashes(g, starts, ends + span - 1)


def minimizers_udf(units: Units):
    @F.arrow_udf("array<bigint>")
    def minimizers(texts: pa.Array) -> pa.Array:
        found, lengths = [], []
        for raw in to_bytes(texts):
            g = units.grams(raw or b"")
            own = minimizer_grams(g, units.span) if len(g) >= units.span else g[:0]
            found.append(own)
            lengths.append(len(own))
        flat = np.concatenate(found) if found else np.zeros(0, np.uint64)
        return list_array(pa.array(flat.view(np.int64)), lengths)
    return minimizers


def segments_udf(units: Units):
    @F.arrow_udf(SEGMENTS)
    def segs(texts: pa.Array) -> pa.Array:
        found, lengths = [], []
        for raw in to_bytes(texts):
            g = units.grams(raw or b"")
            if len(g) >= units.span:
                own = segments(g, units.span)
                found.append(own)
                lengths.append(len(own[0]))
            else:
                lengths.append(0)
        cols = [np.concatenate([x[i] for x in found]) if found else np.zeros(0, np.uint64)
                for i in range(4)]
        return list_array(pa.StructArray.from_arrays(
            [pa.array(cols[0].astype(np.int32)), pa.array(cols[1].astype(np.int32)),
             pa.array(cols[2].astype(np.uint64).view(np.int64)),
             pa.array(cols[3].astype(np.uint64).view(np.int64))],
            ["start", "nwin", "mini", "sh"]), lengths)
    return segs


def _field(lists: pa.Array, name: str) -> np.ndarray:
    return lists.flatten().field(name).to_numpy(zero_copy_only=False)


def cuts_udf(units: Units):
    """The encoded text of each listed segment."""
    @F.arrow_udf("array<binary>")
    def cuts(texts: pa.Array, segs: pa.Array) -> pa.Array:
        lengths = segs.value_lengths().to_numpy(zero_copy_only=False)
        starts, nwin = _field(segs, "start"), _field(segs, "nwin")
        ends = starts + nwin + units.window - 1
        out, at = [], 0
        for raw, n in zip(to_bytes(texts), lengths.tolist(), strict=True):
            out.extend(units.cut(raw, starts[at:at + n].tolist(), ends[at:at + n].tolist()))
            at += n
        return list_array(pa.array(out, pa.binary()), lengths)
    return cuts


def window_hashes_udf(units: Units):
    """(offset, 128-bit hash) of every window of an encoded segment."""
    @F.arrow_udf("array<struct<j:int,h1:bigint,h2:bigint>>")
    def hashes(segs: pa.Array) -> pa.Array:
        js, h1, h2, lengths = [], [], [], []
        for raw in to_bytes(segs):
            g = units.grams(raw)
            s = np.arange(len(g) - units.span + 1)
            js.append(s.astype(np.int32))
            h1.append(range_hashes(g, s, s + units.span))
            h2.append(range_hashes(mix64(g + np.uint64(1)), s, s + units.span))
            lengths.append(len(s))
        if not js:
            js, h1, h2 = [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        return list_array(pa.StructArray.from_arrays(
            [pa.array(np.concatenate(js)), pa.array(np.concatenate(h1).view(np.int64)),
             pa.array(np.concatenate(h2).view(np.int64))], ["j", "h1", "h2"]), lengths)
    return hashes


def _runs(rows: np.ndarray, offsets: np.ndarray):
    """(row, first, end) of the runs of neighbouring offsets, given in order."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (offsets[1:] != offsets[:-1] + 1)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(rows)) - 1 if len(at) else at
    return rows[at], offsets[at], offsets[last] + 1


def shard_parts(mini: np.ndarray, width: np.ndarray, most: int):
    """Row numbers of a shard in parts of about ``most`` units that share no minimizer; only
    the segments of one minimizer are never parted."""
    order = np.argsort(mini, kind="stable")
    first = np.flatnonzero(np.concatenate(([True], mini[order][1:] != mini[order][:-1]))[:len(order)])
    size = np.add.reduceat(width[order], first) if len(order) else width[:0]
    begin, held = 0, 0
    for at, n in zip(first.tolist(), size.tolist(), strict=True):
        if held and held + n > most:
            yield order[begin:at]
            begin, held = at, 0
        held += n
    yield order[begin:]


def repeated_windows(docs: DataFrame, units: Units, index, shard_units: int,
                     group_units: int, scratch: Scratch) -> DataFrame:
    """(id, th, dups): per document (id and text hash) the repeated windows as ranges [a, b)
    of start units. ``docs`` has the columns id, t, th. ``index(segments, many)`` gets the
    encoded distinct segments of a shard, and for each whether it has copies, and returns
    the repeated windows as (segment number, offset) arrays in ascending order."""
    read = docs.select("id", "th", "t")
    write_table = scratch.write  # the joins below are between tables, so hot keys can be split
    twice = (read.select(F.explode(minimizers_udf(units)("t")).alias("mini"))
             .groupBy("mini").count().where("count >= 2").select("mini"))
    twice = write_table(twice, "twice")
    found = (read.select("id", "th", F.explode(segments_udf(units)("t")).alias("s"))
             .select("id", "th", "s.*").join(twice, "mini"))
    found = write_table(found.select("id", "th", "start", "nwin", "mini", "sh"), "segments")
    scratch.drop("twice")
    kinds = write_table(
        # any one row stands for its copies; first() takes all columns from the same row
        found.groupBy("mini", "sh").agg((F.count(F.lit(1)) > 1).alias("many"), *[
            F.first(c).alias(c) for c in ("id", "th", "start", "nwin")]),
        "kinds")
    # a segment with copies is laid down twice
    width = (F.col("nwin") + (units.window - 1)) * F.when(F.col("many"), 2).otherwise(1)
    total = kinds.agg(F.sum(width).alias("n")).first()["n"] or 0
    shards = max(1, -(-total // shard_units))
    hot = (kinds.groupBy("mini").agg(F.sum(width).alias("u")).where(F.col("u") > group_units)
           .select("mini", F.lit(True).alias("hot")))
    wanted = (kinds.join(hot, "mini", "left").withColumn("over", F.coalesce("hot", F.lit(False)))
              .groupBy("id", "th").agg(F.collect_list(
                  F.struct("start", "nwin", "mini", "sh", "many", "over")).alias("segs")))
    wanted = wanted.select(F.col("id").alias("wid"), F.col("th").alias("wth"), "segs")
    cut = (read.join(wanted, F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth")))
           .select("id", "th", F.explode(F.arrays_zip(F.col("segs"), cuts_udf(units)(
               "t", F.col("segs")).alias("cut"))).alias("x"))
           .select("id", "th", "x.segs.*", "x.cut").drop("nwin"))
    cut = write_table(cut, "cuts")
    scratch.drop("kinds")
    part_bytes = PART_BYTES
    shape = T.StructType([
        T.StructField("id", docs.schema["id"].dataType), T.StructField("th", T.LongType()),
        T.StructField("start", T.IntegerType()), T.StructField("mini", T.LongType()),
        T.StructField("sh", T.LongType()), T.StructField("many", T.BooleanType()),
        T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    keys = [f.name for f in shape][:6]

    def search(table: pa.Table) -> pa.Table:
        many = table.column("many").to_numpy()
        width = pc.binary_length(table.column("cut")).to_numpy().astype(np.int64) * (1 + many)
        found = []
        for own in shard_parts(table.column("mini").to_numpy(), width, part_bytes):
            rows, a, b = _runs(*index(table.column("cut").take(pa.array(own)).to_pylist(), many[own]))
            found.append((own[rows.astype(np.int64)], a, b))
        rows, a, b = (np.concatenate([x[k] for x in found]) for k in range(3))
        picked = table.select(keys).take(pa.array(rows.astype(np.int64)))
        return pa.Table.from_arrays(
            [*picked.columns, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
            [*keys, "a", "b"])

    shared = (cut.where("not over").withColumn("shard", F.pmod(F.xxhash64("mini"), F.lit(shards)))
              .groupBy("shard").applyInArrow(search, shape))
    dealt = (cut.where("over").select(*keys, F.explode(window_hashes_udf(units)("cut")).alias("w"))
             .select(*keys, "w.*"))
    often = (dealt.groupBy("h1", "h2").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n"))
             .where("n >= 2").select("h1", "h2"))
    by_window = (dealt.join(often, ["h1", "h2"])
                 .select(*keys, F.col("j").alias("a"), (F.col("j") + 1).cast("int").alias("b")))
    hits = write_table(shared.unionByName(by_window), "hits")
    scratch.drop("cuts")

    def ranges(df: DataFrame) -> DataFrame:
        return df.select("id", "th", (F.col("start") + F.col("a")).alias("a"),
                         (F.col("start") + F.col("b")).alias("b"))

    alone = ranges(hits.where("not many"))
    copies = ranges(found.drop("nwin").join(hits.where("many").select("mini", "sh", "a", "b"), ["mini", "sh"]))
    return (alone.unionByName(copies).groupBy("id", "th")
            .agg(F.collect_set(F.struct("a", "b")).alias("dups")))


def covered(dups: pa.Array, window: int):
    """Per row the maximal covered unit runs (starts, ends) of its repeated windows."""
    lengths = dups.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    a, b = _field(dups, "a"), _field(dups, "b")
    at = 0
    for n in lengths.tolist():
        yield merged_runs(a[at:at + n], b[at:at + n] + (window - 1))
        at += n


def with_repeats(docs: DataFrame, id_col: str, text_col: str, units: Units, index,
                 shard_units: int, group_units: int) -> DataFrame:
    """Rows of ``docs`` as struct ``row`` with text ``t`` and ``dups`` (null: none)."""
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs[id_col].alias("id"), docs[text_col].alias("t"))
    base = base.withColumn("th", text_hash("t"))
    bounded_batches(docs.sparkSession)
    scratch = Scratch(docs.sparkSession, "repeats")
    dups = repeated_windows(base.select("id", "t", "th"), units, index, shard_units, group_units, scratch)
    dups = write_table(dups.select(F.col("id").alias("did"), F.col("th").alias("dth"), "dups"), "dups")
    scratch.remove()
    return (base.join(dups, F.col("id").eqNullSafe(F.col("did")) & (F.col("th") == F.col("dth")), "left")
            .select("row", "t", F.col("dups").cast(RANGES).alias("dups")))
