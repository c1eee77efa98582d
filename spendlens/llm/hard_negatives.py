"""Hard negatives by Fagin's threshold algorithm over integer inner products.

Rows are dealt by hash into shards of bounded size. A shard keeps one list per dimension,
sorted by the component. For an anchor the lists are read from the end its own component's
sign makes best (sorted access); every row met for the first time is scored in full by its
integer inner product (random access); after each depth the threshold, the best score a row
not yet met could have, is the inner product of the anchor with the components at that
depth. Reading stops once the threshold is strictly below the k-th score of every window,
so ties at the k-th place are always met.

Two passes: the positives of every anchor (rows of its label), then, for each positive, the
negatives whose score lies in the window its score sets. Anchors are a stated query set:
blocks of them are sent to every shard, and a shard's few best per anchor are ranked again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import write_table

#: Rows of a shard and anchors of a group, on average.
SHARD_ROWS, GROUP_ANCHORS = 8192, 4096
#: Depths read between two looks at the threshold.
FIRST_DEPTHS = 16
SCALE = 256
#: Components are held to this size, so that inner products of up to 512 fit a long.
LARGEST = 1 << 27
#: Sums below this size are exact in floating point.
EXACT = float(1 << 53)
#: Part of a unit: the candidates come first, then the anchors in any order.
CANDIDATE, ANCHOR = 0, 1


def quantised(vector: Column) -> Column:
    """floor(256 x) of every component as an int, or null where the vector is null or has a
    null or non-finite component. Sizes beyond ``LARGEST`` are held to it."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))

    def cell(x):
        held = F.greatest(F.least(x.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))
        return F.floor(held).cast("int")

    return F.when(~bad, F.transform(vector, cell))


def mining_rows(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
                vector_col: str = "embedding") -> DataFrame:
    """(id, label, v): the rows that take part, equal rows once."""
    rows = vectors.select(vectors[id_col].alias("id"), vectors[label_col].alias("label"),
                          quantised(vectors[vector_col]).alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).distinct()


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of integer components, padded with zeros to ``width``."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Shard:
    """Candidates with one list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        self.lists = np.argsort(self.x, axis=0, kind="stable").astype(np.int32)
        self.steps = np.take_along_axis(self.x, self.lists, 0)  # components in list order
        self.widest = float(np.abs(self.x).max(initial=0))
        self.real = self.x.astype(np.float64) if self.x.size else self.x

    def only(self, label: int) -> Shard:
        own = self.labels == label
        return Shard(self.ids[own], self.labels[own], self.x[own])

    def access(self, anchor: np.ndarray):
        """Blocks of (rows met for the first time, their scores, threshold after them)."""
        n = len(self.ids)
        # Sums this small are exact in floating point, where products are much faster.
        exact = float(np.abs(anchor).sum()) * self.widest < EXACT
        real = anchor.astype(np.float64)
        use = np.flatnonzero(anchor)
        down = anchor[use] > 0
        seen = np.zeros(n, bool)
        at, depth = 0, FIRST_DEPTHS
        if not len(use):  # every score is zero, and so is the threshold
            if n:
                yield np.arange(n), np.zeros(n, np.int64), -1
            return
        while at < n:
            end = min(n, at + depth)
            fresh = np.zeros(n, bool)
            fresh[self.lists[n - end:n - at, use[down]]] = True
            fresh[self.lists[at:end, use[~down]]] = True
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            if exact:
                scores = np.rint(self.real[new] @ real).astype(np.int64)
            else:
                scores = self.x[new] @ anchor
            last = np.where(down, self.steps[n - end, use], self.steps[end - 1, use])
            yield new, scores, int(last @ anchor[use])
            if seen.all():
                return
            at, depth = end, depth * 2


class Best:
    """The first ``k`` rows of one window, by descending score and ascending id."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def offer(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if self.low is not None:
            inside = (100 * scores >= self.low) & (100 * scores <= self.high)
            ids, scores = ids[inside], scores[inside]
        if len(self.ids) == self.k:
            good = scores >= self.scores[-1]
            ids, scores = ids[good], scores[good]
        if not len(ids):
            return
        ids, scores = np.concatenate((self.ids, ids)), np.concatenate((self.scores, scores))
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]

    def settled(self, threshold: int) -> bool:
        """No row that scores at most ``threshold`` can change the window any more."""
        if self.low is not None and (100 * threshold < self.low or self.low > self.high):
            return True
        return len(self.ids) == self.k and threshold < self.scores[-1]


def mine(shard: Shard, anchor_id: int, label: int, anchor: np.ndarray, windows: list[Best],
         same: bool) -> list[Best]:
    """Threshold algorithm for one anchor over one shard; ``same`` takes the rows of its own
    label (other ids only), otherwise the rows of the other labels."""
    if all(w.settled(np.iinfo(np.int64).max // 200) for w in windows):
        return windows
    for rows, scores, threshold in shard.access(anchor):
        use = (shard.ids[rows] != anchor_id) if same else (shard.labels[rows] != label)
        ids, scores = shard.ids[rows[use]], scores[use]
        for w in windows:
            w.offer(ids, scores)
        if all(w.settled(threshold) for w in windows):
            break
    return windows


@dataclass
class Plan:
    """What is sent where: every unit is one shard and one group of anchors."""
    shards: int
    groups: int
    width: int

    @classmethod
    def of(cls, rows: DataFrame, every: int) -> Plan:
        n, anchors, width = rows.agg(F.count(F.lit(1)), F.count_if(F.col("id") % every == 0),
                                     F.max(F.size("v"))).first()
        return cls(max(1, -(-n // SHARD_ROWS)), max(1, -(-anchors // GROUP_ANCHORS)), width or 0)

    def units(self, rows: DataFrame, anchors: DataFrame) -> DataFrame:
        """Candidates and anchors, each copied to its units; a unit's candidates come first."""
        mix = F.xxhash64("id", "v")
        shard, group = F.pmod(mix, F.lit(self.shards)), F.pmod(mix, F.lit(self.groups))
        every_group, every_shard = (F.sequence(F.lit(0), F.lit(n - 1)) for n in (self.groups, self.shards))
        none = F.array().cast("array<bigint>")
        c = rows.select((shard * self.groups).alias("base"), F.explode(every_group).alias("g"), F.lit(CANDIDATE).alias("part"),
                        "id", "label", "v", F.lit(0).cast("long").alias("row"), none.alias("marks"), none.alias("positives"))
        a = anchors.select(group.alias("base"), F.explode(every_shard).alias("g"), F.lit(ANCHOR).alias("part"),
                           "id", "label", "v", "row", "marks", "positives")
        both = c.select((F.col("base") + F.col("g")).alias("unit"), *c.columns[2:]).unionByName(
            a.select((F.col("base") + F.col("g") * self.groups).alias("unit"), *a.columns[2:]))
        # As many partitions as units at most, so the units spread over the tasks.
        return (both.repartition(self.shards * self.groups, "unit")
                .sortWithinPartitions("unit", "part", "id"))


#: ``row`` tells anchors of one id apart, ``place`` the positives of an anchor.
FOUND = ["anchor_id", "row", "place", "positive_id", "positive_score", "id", "score"]
FOUND_SCHEMA = ", ".join(f"{c} bigint" for c in FOUND)


def _search(width: int, k: int, same: bool):
    """Arrow function over sorted units: the shard's first rows of every window."""
    def run(batches):
        unit, parts, shard, by_label = None, [], None, {}
        for batch in batches:
            units, part = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cuts = np.flatnonzero((units[1:] != units[:-1]) | (part[1:] != part[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(units)], strict=True):
                if hi == lo:
                    continue
                if units[lo] != unit:
                    unit, parts, shard, by_label = units[lo], [], None, {}
                piece = batch.slice(lo, hi - lo)
                ids, labels = (piece.column(i).to_numpy(zero_copy_only=False) for i in (2, 3))
                x = _matrix(piece.column(4), width)
                if part[lo] == CANDIDATE:  # bounded by the shard's size
                    parts.append((ids, labels.astype(np.int64), x))
                    continue
                if shard is None:
                    cols = zip(*parts, strict=True) if parts else ([np.zeros(0, np.int64)], [np.zeros(0, np.int64)],
                                                                   [np.zeros((0, width), np.int64)])
                    shard = Shard(*(np.concatenate(list(c)) for c in cols))
                    parts = []
                out = []
                keys, marks, positives = (piece.column(i).to_pylist() for i in (5, 6, 7))
                for i in range(hi - lo):
                    label = int(labels[i])
                    if same:
                        if label not in by_label:
                            by_label[label] = shard.only(label)
                        where, windows = by_label[label], [Best(k)]
                        of = [(0, 0)]
                    else:
                        where, of = shard, list(zip(positives[i], marks[i], strict=True))
                        windows = [Best(k, 50 * s, 95 * s) for _, s in of]
                    mine(where, int(ids[i]), label, x[i], windows, same)
                    for place, ((p, s), w) in enumerate(zip(of, windows, strict=True)):
                        out += [(int(ids[i]), keys[i], place, p, s, a, b)
                                for a, b in zip(w.ids.tolist(), w.scores.tolist(), strict=True)]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], FOUND)
    return run


def _first(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group with their rank; the limit is applied before the shuffle too."""
    w = Window.partitionBy(*by).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label",
                   vector_col: str = "embedding", every: int = 50, positives: int = 5,
                   negatives: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; their positives the first
    ``positives`` rows of the same label and another id; the negatives of a positive the
    first ``negatives`` rows of other labels whose score is 50 to 95 percent of the
    positive's (so a negative positive score has none, and a score of zero has zeros). First
    means higher score, then smaller id.

    Rows with a null id, label or vector, or with a null or non-finite component, take no
    part. Equal rows count once; different rows of one id are rows of their own, as anchors,
    positives and negatives. Vectors of different lengths are filled
    with zeros, so an empty one scores zero. No rows, one label or no anchor give an empty
    table. No other column is read, whatever its name.
    """
    rows = write_table(mining_rows(vectors, id_col, label_col, vector_col), "vectors")
    plan = Plan.of(rows, every)
    anchors = rows.where(F.col("id") % every == 0).withColumn("row", F.xxhash64("label", "v"))
    none = F.array().cast("array<bigint>")
    units = plan.units(rows, anchors.select("*", none.alias("marks"), none.alias("positives")))
    near = units.mapInArrow(_search(plan.width, positives, True), FOUND_SCHEMA)
    own = (_first(near, ["anchor_id", "row"], positives)
           .groupBy("anchor_id", "row").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p")))
    own = write_table(own.withColumnRenamed("row", "of"), "positives")  # at most ``positives`` entries an anchor
    marked = anchors.join(own, (anchors["id"] == own["anchor_id"]) & (anchors["row"] == own["of"])).select(
        "id", "label", "v", "row", F.col("p.score").alias("marks"), F.col("p.id").alias("positives"))
    far = plan.units(rows, marked).mapInArrow(_search(plan.width, negatives, False), FOUND_SCHEMA)
    best = _first(far, ["anchor_id", "row", "place"], negatives)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                       F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
