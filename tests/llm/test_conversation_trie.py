"""Conversation trie against brute force over dictionaries."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from spendlens.llm import conversation_trie as T

SCHEMA = "conv_id bigint, turn int, role string, text string, conv bigint, depth string, words int"


def _order(turns):
    def name(r, t):
        return hashlib.md5(b"%d:%b%b" % (len(r.encode()), r.encode(), t.encode())).hexdigest()
    rows = [(turn, r or "", t or "") for turn, r, t in turns]
    return [(r, t) for _, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], name(x[1], x[2])))]


def _brute(rows, graft=True):
    convs: dict = {}
    for c, turn, r, t in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, r, t))
    own = {c: _order(t) for c, t in convs.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        built[c] = own.get(base, [])[:h] + own[c][h:] if graft else own[c]
    nodes: dict = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    children: dict = {}
    for k in nodes:
        if k:
            children.setdefault(k[:-1], []).append(k)
    out, sums = [], {}
    for k in sorted(nodes, key=len, reverse=True):
        below = [sums[x] for x in children.get(k, [])]
        words = len(k[-1][1].encode().split()) if k else 0
        sums[k] = (sum(x[0] for x in below) or 1, sum(x[1] for x in below) + (len(nodes[k]) - 1) * words)
        ends = sorted(c for c in nodes[k] if len(built[c]) == len(k))
        out.append((min(nodes[k]), len(k), min(nodes[k[:-1]]) if k else None, len(nodes[k]), len(children.get(k, [])),
                    *sums[k], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def _frame(spark, rows):
    return spark.createDataFrame([(c, turn, r, t, 3, "depth", 4) for c, turn, r, t in rows], SCHEMA)


def _got(df):
    assert df.columns == T.NODE
    return sorted((tuple(r) for r in df.collect()), key=str)


def _rows(seed=2):
    rng = random.Random(seed)
    says = ["hello there", "hello", "", None, "how are you", "fine  thanks", "x " * 50]
    out = []
    for c in range(0, 130):
        for t in range(rng.randint(1, 6)):
            out.append((c, t, rng.choice(["user", "bot", None, ""]), rng.choice(says)))
    for c in range(200, 260):  # copies, and a common first turn
        out += [(c, t, "user", f"copy {t}") for t in range(5)]
    for c in (-7, -20, -21, 0):
        out.append((c, 0, "user", "negative or zero"))
    out += [(300, 3, "user", "b"), (300, 3, "user", "a"), (300, None, "bot", "first"), (300, 3, "bot", "c"), (300, 3, "user", "b")]
    out += [(None, 0, "user", "nobody"), (None, None, None, None), (301, None, None, None), (302, None, None, None)]
    for c in (1000, 1001, 1003, 1009, 1010):  # long ones that share much, and one alone
        out += [(c, t, "user", f"turn {t} word") for t in range(150 - c % 7)]
    out += [(1040, t, "bot", f"{t}") for t in range(200)] + [(1100, t, "bot", "same") for t in range(64)]
    return out + out[:9]


@pytest.mark.parametrize("shard, block", [(16384, 64), (20, 64), (9, 4)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(T, "SHARD_ROWS", shard)
    monkeypatch.setattr(T, "BLOCK", block)
    rows = _rows()
    if block == 4:  # three levels of shared blocks
        rows = [r for r in rows if r[0] is None or r[0] < 1000 or r[1] < 12]
    assert _got(T.conversation_trie(_frame(spark, rows))) == _brute(rows)


def test_plain_conversations_and_empty_tables(spark):
    rows = _rows(9)[:400]
    assert _got(T.conversation_trie(_frame(spark, rows), graft=False)) == _brute(rows, graft=False)
    assert _got(T.conversation_trie(_frame(spark, []))) == []
    assert _got(T.conversation_trie(_frame(spark, [(None, 0, "user", "x")]))) == []
    one = [(5, 0, "user", "only")]
    assert _got(T.conversation_trie(_frame(spark, one))) == _brute(one)


def test_shards_cut_anywhere_add_up():
    """Kernel property: the parts of cut nodes of any cut into ranges give the whole."""
    rng = np.random.default_rng(0)
    seqs = sorted(tuple(rng.integers(0, 2, rng.integers(0, 5)).tolist()) for _ in range(40))
    names = {i: hashlib.md5(b"%d" % i).hexdigest().encode() for i in (0, 1)}
    seqs.sort(key=lambda s: b"".join(names[i] for i in s))

    def run(lo, hi):
        part = seqs[lo:hi]
        sizes = np.array([len(s) for s in part])
        zero = np.zeros(len(part), np.int64)
        flat = np.array([names[i] for s in part for i in s], "S32")
        return T.shard_nodes(zero, zero, flat, sizes, np.ones(sizes.sum() + len(part), np.int64),
                             np.arange(lo, hi), zero, zero, 64, 0)
    expected = {}
    for s in seqs:
        for d in range(len(s) + 1):
            expected[s[:d]] = expected.get(s[:d], 0) + 1
    for cut in (0, 1, 13, 25, 39):
        found = [r for lo, hi in ((0, cut), (cut, 40)) if hi > lo for r in run(lo, hi)]
        parts: dict = {}
        for r in found:
            if r[0] == T.PART:
                parts[r[1]] = parts.get(r[1], 0) + r[6]
        sizes = sorted([r[6] for r in found if r[0] == T.INSIDE] + list(parts.values()))
        assert sizes == sorted(expected.values())
