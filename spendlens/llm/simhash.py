"""SimHash near-dedup over a popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. Flipping one
bit moves one count by one, so the Manhattan distance of two embeddings is a lower bound of
the Hamming distance. The range join "distance <= 3" runs on a grid: the 32 coordinates
are dealt into six groups, and two embeddings within distance 3 differ in at most three
groups, so they agree on some three of six. Every choice of three groups with its counts is
one grid cell; cell mates are checked by the Manhattan bound and then by the exact Hamming
distance.

Only distinct fingerprints take part: copies collapse by a partial aggregation first. In a
cell the links are reported as a spanning forest, never as all pairs. Cells of more than
``BLOCK`` fingerprints are cut into blocks, and each pair of blocks is a task unit of its
own, so no task holds an unbounded cell and no link is lost.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import bounded_batches, list_array, release, to_bytes, write_table
from spendlens.llm.components import connected_components

SEED = 42
GROUPS = 6
CHOICES = list(combinations(range(GROUPS), GROUPS // 2))
#: 32 segments dealt to six groups.
GROUP_OF = [i * GROUPS // 32 for i in range(32)]
BLOCK = 4096
SMALL = 24


def shingle_spans(n_words: int, width: int) -> int:
    return max(1, n_words - width + 1)


def fingerprints(raws: list, width: int = 3) -> np.ndarray:
    """The fingerprint of each text as uint64; texts without words have zero."""
    out = np.zeros(len(raws), np.uint64)
    h64 = xxhash.xxh64_intdigest
    for row, raw in enumerate(raws):
        words = raw.lower().split() if raw else []
        if not words:
            continue
        n = shingle_spans(len(words), width)
        joined = b" ".join(words)
        if n == 1:
            hashes = np.array([h64(joined, SEED)], np.uint64)
        else:
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))
            hashes = np.fromiter((h64(joined[a:b], SEED) for a, b in zip(
                starts[:n].tolist(), (ends[width - 1:] - 1).tolist(), strict=True)), np.uint64, n)
        ones = np.zeros(64, np.int64)
        for at in range(0, n, 1 << 16):
            part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
            ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        bits = (2 * ones > n).astype(np.uint8)
        out[row] = np.packbits(bits, bitorder="little").view(np.uint64)[0]
    return out


def fingerprint_udf(width: int):
    @F.arrow_udf("bigint")
    def fingerprint(texts: pa.Array) -> pa.Array:
        release()
        return pa.array(fingerprints(to_bytes(texts), width).view(np.int64))
    return fingerprint


def embed(fp: np.ndarray) -> np.ndarray:
    """(n, 32) bit counts of the two-bit segments."""
    two = (fp[:, None] >> (np.arange(32, dtype=np.uint64) * np.uint64(2))) & np.uint64(3)
    return np.bitwise_count(two).astype(np.int64)


def cells(fp: np.ndarray) -> np.ndarray:
    """(n, 20) grid cells: choice of groups and the counts in them, one exact number each."""
    counts = embed(fp)
    codes = np.zeros((len(fp), GROUPS), np.int64)
    for i, g in enumerate(GROUP_OF):
        codes[:, g] = codes[:, g] * 3 + counts[:, i]
    return np.stack([((c * 729 + codes[:, g[0]]) * 729 + codes[:, g[1]]) * 729 + codes[:, g[2]]
                     for c, g in enumerate(CHOICES)], 1)


def cells_udf():
    @F.arrow_udf("array<bigint>")
    def grid_cells(fps: pa.Array) -> pa.Array:
        grid = cells(fps.to_numpy(zero_copy_only=False).view(np.uint64))
        return list_array(pa.array(grid.ravel()), np.full(len(grid), len(CHOICES)))
    return grid_cells


def _near(a, b, max_bits: int) -> np.ndarray:
    """Within the Manhattan bound of the embeddings, then within the exact distance."""
    x = a ^ b
    odd = np.uint64(0x5555555555555555)
    # |count(a) - count(b)| of a two-bit segment is the parity of its difference, plus two
    # where both bits differ in the same direction (00 against 11).
    parity = (x ^ (x >> np.uint64(1))) & odd
    both = x & (x >> np.uint64(1)) & odd
    same = ~(a ^ (a >> np.uint64(1))) & both
    bound = np.bitwise_count(parity) + 2 * np.bitwise_count(same)
    return (bound <= max_bits) & (np.bitwise_count(x) <= max_bits)


def _forest(fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links of one unit, breadth first."""
    left, out = fp[1:], []
    queue = [fp[0]]
    while True:
        while queue and len(left):
            here = queue.pop()
            near = _near(left, here, max_bits)
            if near.any():
                new = left[near]
                out.append((np.full(len(new), here, np.uint64), new))
                queue.extend(new)
                left = left[~near]
        if not len(left):
            return out
        queue, left = [left[0]], left[1:]


def unit_links(unit: np.ndarray, fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of all units of a sorted batch: all units of up to SMALL members at once, by
    shifting the batch against itself, and larger ones by a forest each."""
    starts = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    sizes = np.diff(np.append(starts, len(unit)))
    a, b = [], []
    of = np.repeat(sizes, sizes)
    small = np.flatnonzero((of > 1) & (of <= SMALL))
    for d in range(1, min(SMALL, int(sizes.max(initial=1)))):
        i = small[small + d < len(unit)]
        i = i[unit[i] == unit[i + d]]
        if not len(i):
            break
        i = i[_near(fp[i], fp[i + d], max_bits)]
        a.append(fp[i])
        b.append(fp[i + d])
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        for x, y in _forest(fp[s:s + n], max_bits):
            a.append(x)
            b.append(y)
    if not a:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    return np.concatenate(a), np.concatenate(b)


def _links(max_bits: int):
    def run(batches):
        rest_u, rest_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            u = np.concatenate((rest_u, batch.column(0).to_numpy(zero_copy_only=False)))
            f = np.concatenate((rest_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if not len(u):
                continue
            cut = int(np.searchsorted(u, u[-1]))  # the last unit may go on in the next batch
            rest_u, rest_f = u[cut:], f[cut:]
            if cut:
                yield _edges(*unit_links(u[:cut], f[:cut], max_bits))
        if len(rest_u):
            yield _edges(*unit_links(rest_u, rest_f, max_bits))
    return run


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    both = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b)), 1), axis=0)
    return pa.RecordBatch.from_arrays(
        [pa.array(both[:, i].astype(np.uint64).view(np.int64)) for i in (0, 1)], ["a", "b"])


def near_links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Spanning links (a, b) between the distinct fingerprints of column ``fp``."""
    dealt = distinct.select("fp", F.explode(cells_udf()("fp")).alias("cell"))
    big = write_table(dealt.groupBy("cell").count().where(F.col("count") > BLOCK)
                      .select("cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large-cells")
    dealt = dealt.join(big, "cell", "left")
    # A fingerprint of block x of a large cell goes to the units (x, y) of every y.
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    units = F.when(F.col("blocks").isNull(), F.array(F.col("cell"))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.xxhash64(
            F.col("cell"), F.least(own, y.cast("long")), F.greatest(own, y.cast("long")))))
    rows = dealt.select(F.explode(units).alias("unit"), "fp")
    return (rows.repartition("unit").sortWithinPartitions("unit", "fp")
            .mapInArrow(_links(max_bits), "a bigint, b bigint"))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = 3, max_bits: int = 3, extra: list | None = None) -> DataFrame:
    """One row per document: id, fp (64-bit fingerprint as a long), component_id, and the
    ``extra`` columns (expressions over ``docs``).

    component_id is the smallest id reachable over links of at most ``max_bits`` differing
    bits, the document's own included. Null, empty and wordless texts have fingerprint zero
    and link like any other; fewer than ``width`` words are one shingle. Repeated rows come
    back one by one. Null ids never win the minimum: a component of null ids alone has a
    null component_id. No other column of ``docs`` is read.
    """
    bounded_batches(docs.sparkSession)
    prints = write_table(docs.select(docs[id_col].alias("id"),
                                     fingerprint_udf(width)(docs[text_col]).alias("fp"),
                                     *(extra or [])), "fingerprints")
    distinct = write_table(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = connected_components(near_links(distinct.select("fp"), max_bits))
    roots = roots.select(F.col("node").alias("fp"), "root")
    classes = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = write_table(classes, "classes")
    least = write_table(classes.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    member = write_table(classes.join(least, "root").select("fp", "component_id"), "members")
    return prints.join(member, "fp").select(
        F.col("id").alias(id_col), "fp", "component_id", *[c for c in prints.columns[2:]])
