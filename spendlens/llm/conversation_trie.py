"""Prefix trie of conversations from padded matrices of turn ids.

A turn is named by the MD5 of its role and text, so a conversation is a sequence of names and
texts move no further. Sequences are cut into blocks of ``BLOCK`` turns; a block carries the
hash of everything before it, and blocks with equal such hashes belong together. The blocks
are dealt into shards by ranges of (hash before, names, conversation). In a shard the names
become a padded integer matrix; numpy's lexsort orders its rows; the masks of changed columns,
OR-accumulated from the left, mark where nodes of every depth start; and reduceat aggregates
each depth, the deepest first, so that subtree sums are row sums.

Ranges may cut a node in two: those that hold the first or the last row of a shard (at most
two a depth and shard) leave it in parts, which meet in a small aggregation. Everything else
is final where it is made. However large a group of copies or a common first turn, it is
spread over shards by conversation and leaves one part a shard.

A block whose hash before belongs to one conversation alone needs no matrix: from there on it
is a chain. Blocks of several conversations are taken level by level, the deepest first, so
there are as many rounds as ``BLOCK`` goes into the longest sequence that two conversations
share, and one round where none share ``BLOCK`` turns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlens.functions.keys import broadcast_if_small, dense_index
from spendlens.llm.common import Scratch, bounded_batches, to_bytes, write_table

#: Turns of a block and, on average, block rows of a shard.
BLOCK, SHARD_ROWS = 64, 16384
#: Blocks of one conversation whose hashes are summed in one window.
RUN_BLOCKS = 1024
#: Characters of a turn's name, and conversations in one piece of a digest's input.
NAME, DIGEST_IDS = 32, 4096
#: Parts of cut nodes that are broadcast at most (some 200 bytes each).
SMALL_ROWS = 100_000
EMPTY = hashlib.sha256(b"").hexdigest()
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
INSIDE, INSIDE_STUB, PART, PART_STUB, IDS = range(5)
FOUND = ("kind int, key string, parent_key string, depth bigint, conv_id bigint, parent_conv_id bigint, "
         "n_convs bigint, words bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, "
         "ends string, above array<string>")
FIELDS = [x.split()[0] for x in FOUND.split(", ")]


# ---------------------------------------------------------------- turns

def turn_names():
    """Arrow function (role, text) -> (name, words)."""
    @F.arrow_udf("struct<name:string,words:bigint>")
    def names(roles: pa.Array, texts: pa.Array) -> pa.Array:
        out, words = [], []
        for role, text in zip(to_bytes(roles), to_bytes(texts), strict=True):
            out.append(hashlib.md5(b"%d:%b%b" % (len(role), role, text)).hexdigest())
            words.append(len(text.split()))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(words, pa.int64())], ["name", "words"])
    return names


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conv, idx, name, words) and (conv, first, n): turns by ``idx`` in the order of turn
    (null first), role and name, and each conversation's first ``idx`` and number of turns.
    The order is a range sort of all turns, so no conversation is a group of its own."""
    role, text = (F.coalesce(conversations[c], F.lit("")) for c in (role_col, text_col))
    turns = conversations.where(conversations[conv_col].isNotNull()).select(
        conversations[conv_col].cast("long").alias("conv"), conversations[turn_col].alias("turn"),
        role.alias("role"), turn_names()(role, text).alias("t"))
    turns = turns.select("conv", "turn", "role", "t.name", "t.words")
    placed = dense_index(turns, [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("name")])
    placed = placed.select("conv", "idx", "name", "words")
    return placed, placed.groupBy("conv").agg(F.min("idx").alias("first"), F.count(F.lit(1)).alias("n"))


def grafted(placed: DataFrame, convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """(conv, depth, name, words) of the rebuilt conversations; depth 0 is there for each.

    Conversation c starts with the first h turns of conversation c - c % ``every`` (all of
    them if it has fewer, none if there is none) and goes on with its own turns after its
    first h, where h is the crc32 of c in decimals, modulo ``most``.
    """
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    own = convs.withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % every)
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    info = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    info = write_table(info.select("conv", "base", "first", "h", "taken"), "grafts")
    turns = placed.join(info.select("conv", "first", "h", "taken"), "conv").withColumn("pos", F.col("idx") - F.col("first") + 1)
    rest = turns.where("pos > h").select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("depth"), "name", "words")
    heads = turns.where(F.col("pos") < most).select(F.col("conv").alias("base"), F.col("pos").alias("depth"), "name", "words")
    start = info.where("taken > 0").select("conv", "base", "taken").join(heads, "base").where("depth <= taken")
    root = info.select("conv", F.lit(0).cast("long").alias("depth"), F.lit("").alias("name"), F.lit(0).cast("long").alias("words"))
    return rest.unionByName(start.select("conv", "depth", "name", "words")).unionByName(root)


def plain(placed: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, name, words) of the conversations as they are."""
    turns = placed.join(convs.select("conv", "first"), "conv")
    rows = turns.select("conv", (F.col("idx") - F.col("first") + 1).alias("depth"), "name", "words")
    return rows.unionByName(convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit("").alias("name"),
                                         F.lit(0).cast("long").alias("words")))


# ---------------------------------------------------------------- blocks

def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """(conv, blk, seq, words): the names of a block's turns in one string, and the words of
    the turn before it and of its own turns. The turn that ends a block opens the next one
    too, so a conversation of exactly ``block`` turns has an empty second block."""
    last = (F.col("depth") > 0) & (F.col("depth") % block == 0)
    at = F.struct(((F.col("depth") - 1) / block).cast("long").alias("blk"),
                  ((F.col("depth") - 1) % block + 1).alias("pos"), F.col("name"))
    opens = F.struct((F.col("depth") / block).cast("long").alias("blk"), F.lit(0).cast("long").alias("pos"), F.lit("").alias("name"))
    where = F.when(F.col("depth") == 0, F.array(opens)).when(last, F.array(at, opens)).otherwise(F.array(at))
    cells = rows.select("conv", "words", F.explode(where).alias("c")).select("conv", "c.blk", F.struct("c.pos", "c.name", "words").alias("t"))
    out = cells.groupBy("conv", "blk").agg(F.sort_array(F.collect_list("t")).alias("t"))  # block + 1 turns at most
    return out.select("conv", "blk", F.array_join("t.name", "").alias("seq"), F.col("t.words").alias("words"))


def _before(blocks: DataFrame) -> DataFrame:
    """conv, blk > 0, (p1, p2): 128 bits over all blocks before, position by position. The
    running XOR is taken in runs of ``RUN_BLOCKS`` blocks and over the runs, so that no
    window holds a long conversation whole."""
    long = blocks.join(blocks.where("blk = 1").select("conv"), "conv", "left_semi")
    b = long.select("conv", "blk", (F.col("blk") / RUN_BLOCKS).cast("long").alias("run"),
                    F.xxhash64("blk", "seq").alias("a"), F.xxhash64(F.lit("second"), "seq", "blk").alias("b"))
    totals = b.groupBy("conv", "run").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    prior = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("conv", "run").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv", "run", *[F.coalesce(F.bit_xor(c).over(prior), F.lit(0)).alias(f"{c}0") for c in "ab"])
    own = b.select("conv", "run", "blk", *[F.coalesce(F.bit_xor(c).over(inner), F.lit(0)).alias(f"{c}1") for c in "ab"])
    return own.where("blk > 0").join(totals, ["conv", "run"]).select(
        "conv", "blk", F.col("a0").bitwiseXOR(F.col("a1")).alias("p1"), F.col("b0").bitwiseXOR(F.col("b1")).alias("p2"))


# ---------------------------------------------------------------- one shard

def shard_nodes(p1, p2, names, sizes, words, conv, more_leaves, more_saved, block: int, first_depth: int) -> list[tuple]:
    """The nodes and cut nodes of one shard, column by column (see ``FIELDS``).

    ``names`` holds the names of all rows one after another, ``sizes`` how many each row has,
    ``words`` the words of each row's turns (``sizes + 1``). A row of ``block`` names goes on
    below: its stub brings ``more_leaves`` and ``more_saved`` from there.
    """
    n, width = len(sizes), int(sizes.max(initial=0))
    ids = np.unique(names, return_inverse=True)[1].astype(np.int32) if len(names) else np.zeros(0, np.int32)
    row, start = np.repeat(np.arange(n), sizes), np.cumsum(sizes) - sizes
    matrix, weight = np.full((n, width), -1, np.int32), np.zeros((n, width + 1), np.int64)
    matrix[row, np.arange(len(ids)) - np.repeat(start, sizes)] = ids
    row, wstart = np.repeat(np.arange(n), sizes + 1), start + np.arange(n)
    weight[row, np.arange(len(words)) - np.repeat(wstart, sizes + 1)] = words
    order = np.lexsort((conv, *[matrix[:, j] for j in range(width - 1, -1, -1)], p2, p1))
    p1, p2, conv, m, start = p1[order], p2[order], conv[order], sizes[order], start[order]
    matrix, weight = matrix[order], weight[order]
    changed = np.ones((n, width + 1), bool)
    changed[1:, 0] = (p1[1:] != p1[:-1]) | (p2[1:] != p2[:-1])
    changed[1:, 1:] = matrix[1:] != matrix[:-1]
    np.logical_or.accumulate(changed, axis=1, out=changed)

    starts = [np.flatnonzero(changed[:, j]) for j in range(width + 1)]
    least = [np.minimum.reduceat(conv, s) for s in starts]

    def prefix(r: int, j: int) -> str:
        own = names[start[r]:start[r] + j].tobytes()
        return hashlib.md5(b"%d,%d,%b" % (p1[r], p2[r], own)).hexdigest()

    edge = {r: [prefix(r, j) for j in range(int(m[r]) + 1)] for r in {0, n - 1}}
    leaves, saved, child = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    stub = m == block
    leaves[stub], saved[stub] = more_leaves[order][stub], more_saved[order][stub]
    out = []
    for j in range(width, -1, -1):
        s = starts[j]
        real = m[s] >= j
        cut = np.zeros(len(s), bool)
        cut[[0, -1]] = True
        size = np.diff(np.append(s, n))
        w, children = weight[s, j], np.add.reduceat(child, s)
        whole = real & ~cut
        if j < block:
            saved[s[whole]] += (size[whole] - 1) * w[whole]
            leaves[s[whole]] += children[whole] == 0
        child[:] = 0
        child[s[whole]] = 1
        below = [np.add.reduceat(x, s) for x in (leaves, saved)]
        ending = np.add.reduceat((m == j).astype(np.int64), s) if j < block else np.zeros(len(s), np.int64)
        up = np.searchsorted(starts[j - 1], s, "right") - 1 if j else None
        for g in np.flatnonzero(real).tolist():
            a, k = int(s[g]), int(ending[g])
            parent, parent_key, key, above, ends = None, None, None, None, None
            if cut[g]:
                keys = edge[0] if g == 0 else edge[n - 1]
                key, above = keys[j], keys[:j + 1]
                parent_key = keys[j - 1] if j else None
                for i in range(a, a + k, DIGEST_IDS):
                    text = ",".join(map(str, conv[i:min(i + DIGEST_IDS, a + k)].tolist()))
                    out.append((IDS, key, None, first_depth + j, int(conv[i]), *[None] * 6, text, None))
            else:
                if j:
                    if up[g] in (0, len(starts[j - 1]) - 1):
                        parent_key = edge[0 if up[g] == 0 else n - 1][j - 1]
                    else:
                        parent = int(least[j - 1][up[g]])
                ends = hashlib.sha256(",".join(map(str, conv[a:a + k].tolist())).encode()).hexdigest() if k else EMPTY
            kind = (PART if cut[g] else INSIDE) + (j == block)
            out.append((kind, key, parent_key, first_depth + j, int(least[j][g]), parent, int(size[g]), int(w[g]),
                        int(children[g]), int(below[0][g]), int(below[1][g]), ends, above))
    return out


def _shards(block: int, first_depth: int):
    """One shard a partition: its rows are few by the number of ranges."""
    types = [pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 8, pa.string(), pa.list_(pa.string())]

    def run(batches):
        cols: list[list] = [[] for _ in range(8)]
        for batch in batches:
            if not batch.num_rows:
                continue
            p1, p2, conv, xl, xs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 4, 5, 6))
            joined = b"".join(to_bytes(batch.column(2)))
            words = batch.column(3)
            sizes = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) - 1
            own = (p1, p2, np.frombuffer(joined, f"S{NAME}"), sizes, words.flatten().to_numpy(zero_copy_only=False), conv, xl, xs)
            for c, x in zip(cols, own, strict=True):
                c.append(x)
        if not cols[0]:
            return
        out = shard_nodes(*[np.concatenate(c) for c in cols], block, first_depth)
        for at in range(0, len(out), 1 << 15):
            part = zip(*out[at:at + (1 << 15)], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, types, strict=True)], FIELDS)
    return run


# ---------------------------------------------------------------- shards together

def _digests(batches):
    """(key, digest) over pieces of id lists sorted by key and first id, however many."""
    key, running, keys, digests = None, None, [], []
    for batch in batches:
        for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                if key is not None:
                    keys.append(key)
                    digests.append(running.hexdigest())
                key, running = k, hashlib.sha256(text.encode())
            else:
                running.update(b"," + text.encode())
    if key is not None:
        keys.append(key)
        digests.append(running.hexdigest())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(digests, pa.string())], ["key", "digest"])


def _joined_parts(found: DataFrame) -> DataFrame:
    """Cut nodes put together: one row per key, parents resolved."""
    parts = found.where(F.col("kind").isin(PART, PART_STUB))
    one = parts.groupBy("key").agg(
        F.first("kind").alias("kind"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"),
        F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("words").alias("words"),
        F.sum("n_children").alias("inner_children"), F.sum("n_leaves").alias("inner_leaves"),
        F.sum("saved_tokens").alias("inner_saved"), F.first("above").alias("above"))
    cut_children = parts.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(
        F.count_distinct("key").alias("cut_children"))
    one = one.join(cut_children, "key", "left").withColumn("n_children", F.col("inner_children") + F.coalesce("cut_children", F.lit(0)))
    stub = F.col("kind") == PART_STUB
    one = one.withColumn("own_leaf", F.when(~stub & (F.col("n_children") == 0), 1).otherwise(0)).withColumn(
        "own_saved", F.when(~stub, (F.col("n_convs") - 1) * F.col("words")).otherwise(0))
    below = (one.select(F.explode("above").alias("key"), "own_leaf", "own_saved").groupBy("key")
             .agg(F.sum("own_leaf").alias("cut_leaves"), F.sum("own_saved").alias("cut_saved")))
    ids = (found.where(F.col("kind") == IDS).select("key", "conv_id", F.col("ends").alias("text")).repartition("key")
           .sortWithinPartitions("key", "conv_id").select("key", "text").mapInArrow(_digests, "key string, digest string"))
    up = one.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (one.join(below, "key").join(ids, "key", "left").join(up, "parent_key", "left").select(
        "key", "kind", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("inner_leaves") + F.col("cut_leaves")).alias("n_leaves"),
        (F.col("inner_saved") + F.col("cut_saved")).alias("saved_tokens"),
        F.coalesce("digest", F.lit(EMPTY)).alias("ends_sha256")))


def _level(blocks: DataFrame, block: int, level: int, write) -> tuple[DataFrame, DataFrame]:
    """(nodes, stubs) of all blocks of a level; ``stubs`` has the parent of each node that
    opens the next level: (conv_id, depth, parent_conv_id)."""
    rows = write(blocks.select("p1", "p2", "seq", "words", "conv", "more_leaves", "more_saved"), "blocks")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    found = write(rows.repartitionByRange(shards, "p1", "p2", "seq", "conv")
                  .mapInArrow(_shards(block, level * block), FOUND), "found")
    whole = write(_joined_parts(found), "whole")
    small = whole.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("cut_parent"))
    inside = found.where(F.col("kind").isin(INSIDE, INSIDE_STUB)).join(broadcast_if_small(small, SMALL_ROWS), "parent_key", "left")
    inside = inside.select("kind", "conv_id", "depth", F.coalesce("parent_conv_id", "cut_parent").alias("parent_conv_id"),
                           "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"))
    both = inside.unionByName(whole.select(*inside.columns))
    is_stub = F.col("kind").isin(INSIDE_STUB, PART_STUB)
    return both.where(~is_stub).select(*NODE), both.where(is_stub).select("conv_id", "depth", "parent_conv_id")


def _chains(blocks: DataFrame, block: int) -> DataFrame:
    """Nodes of blocks that one conversation has for itself."""
    depth = F.col("blk") * block
    turns = F.size("words") - 1
    # The node after the block's last turn belongs to the next block where the block is full.
    at = F.explode(F.sequence(F.lit(0), F.least(turns, F.lit(block - 1))))
    d = blocks.select("conv", depth.alias("top"), turns.alias("turns"), at.alias("j"))
    ends = F.col("j") == F.col("turns")
    one = F.lit(1).cast("long")
    return d.select(F.col("conv").alias("conv_id"), (F.col("top") + F.col("j")).alias("depth"), F.col("conv").alias("parent_conv_id"),
                    one.alias("n_convs"), F.when(ends, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
                    F.lit(0).cast("long").alias("saved_tokens"),
                    F.when(ends, F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(EMPTY)).alias("ends_sha256"))


def prefix_trie(rows: DataFrame, block: int | None = None) -> DataFrame:
    """The trie of conversations given as (conv, depth, name, words), depth 0 for each: one
    row per node, see ``conversation_trie``. Depths of a conversation have no gaps."""
    block = block or BLOCK
    spark = rows.sparkSession
    scratch = Scratch(spark, "trie")
    blocks = scratch.write(_blocks(rows, block), "all")
    none = F.lit(0).cast("long")
    extra = {"more_leaves": none, "more_saved": none}
    first = blocks.where("blk = 0").withColumns({"p1": none, "p2": none})
    if blocks.where("blk = 1").isEmpty():
        nodes, _ = _level(first.withColumns(extra), block, 0, scratch.write)
        out = write_table(nodes, "trie")
        scratch.remove()
        return out
    later = scratch.write(blocks.where("blk > 0").join(_before(blocks), ["conv", "blk"]), "later")
    alone = later.groupBy("blk", "p1", "p2").agg(F.count(F.lit(1)).alias("holders"))
    later = scratch.write(later.join(alone, ["blk", "p1", "p2"]), "held")
    chains, shared = later.where("holders = 1"), later.where("holders > 1")
    top = shared.agg(F.max("blk")).first()[0] or 0
    parts, stubs = [_chains(chains, block)], []
    # What hangs below a full block: a chain of its own, or nodes of the next level.
    chain_below = chains.select("conv", (F.col("blk") - 1).alias("blk"), F.lit(1).cast("long").alias("more_leaves"), none.alias("more_saved"))
    below = None
    for level in range(top, -1, -1):
        own = first if level == 0 else shared.where(F.col("blk") == level).select(*first.columns)
        hung = chain_below.where(F.col("blk") == level).drop("blk")
        hung = hung if below is None else hung.unionByName(below)
        own = own.join(hung, "conv", "left").fillna(0, ["more_leaves", "more_saved"])
        nodes, stub = _level(own, block, level, scratch.write)
        nodes = scratch.write(nodes, f"nodes-{level}")
        below = nodes.where(F.col("depth") == level * block).select(
            F.col("conv_id").alias("conv"), F.col("n_leaves").alias("more_leaves"), F.col("saved_tokens").alias("more_saved"))
        parts.append(nodes)
        stubs.append(stub)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    parents = stubs[0]
    for s in stubs[1:]:
        parents = parents.unionByName(s)
    parents = parents.withColumnRenamed("parent_conv_id", "stub_parent")
    opens = (F.col("depth") > 0) & (F.col("depth") % block == 0)
    tops = out.where(opens).join(parents, ["conv_id", "depth"], "left").withColumn(
        "parent_conv_id", F.coalesce("stub_parent", "parent_conv_id"))
    out = write_table(out.where(~opens).unionByName(tops.select(*NODE)), "trie")
    scratch.remove()
    return out


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text", graft: bool = True) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns are ordered by turn, null first, ties by role and by the MD5 of role and text;
    null roles and texts are empty. With ``graft`` conversations are rebuilt first (see
    ``grafted``). A conversation that has no turn left is a member of the root alone. Rows
    with a null conversation take no part; repeated rows are turns of their own; an empty
    table has no node, not even a root. No other column is read, whatever its name.
    """
    bounded_batches(conversations.sparkSession)
    placed, convs = ordered_turns(conversations, conv_col, turn_col, role_col, text_col)
    convs = write_table(convs, "conversations")
    return prefix_trie(grafted(placed, convs) if graft else plain(placed, convs))
