"""A small corpus with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, id bigint, t string, th bigint, row string, n_words bigint"


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def _prose(rng, n):
    return " ".join("".join(rng.choice(["an", "be", "co", "dé", "el", "fo", "gu", "hi"])
                            for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(seed: int = 3) -> list[tuple]:
    """(doc_id, text, lang): nulls, empties, ties, repeated rows, shared passages, copies,
    near copies, self-repeats, constant runs and one very long text."""
    rng = random.Random(seed)
    passage, line = _prose(rng, 80), _prose(rng, 14)
    out = [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (None, "no id here", "fr"),
           (None, None, None), (4, "one", "en"), (5, "Two words", "en")]
    for i in range(10, 30):
        out.append((i, f"{_prose(rng, rng.randint(0, 90))} {passage}\n{_prose(rng, rng.randint(1, 60))}", "en"))
    for i in range(30, 60):
        out.append((i, f"{_prose(rng, 30)}\n  {line.upper() if i % 2 else line}\t\n{_prose(rng, 20)}\n{line}", "fr"))
    copy = _prose(rng, 120)
    out += [(i, copy, "de") for i in range(60, 75)]
    words = copy.split()
    for i in range(75, 95):
        w = list(words)
        w[rng.randrange(len(w))] = "changed"
        out.append((i, " ".join(w), "de"))
    out += [(95, "x" * 1500, "en"), (96, "ab " * 400, "en"), (97, "x" * 700, "en"),
            (98, f"{passage} {passage}", "en"), (99, _prose(rng, 30_000), "en")]
    out += [out[20], out[20], (None, copy, "de"), (None, copy, "de"), (60, "other text of an id twice", "en")]
    return out


def frame(spark, rows):
    """The rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, lang, 7, "t", 9, "row", 11) for i, t, lang in rows], SCHEMA)


def repeated_units(texts: list, split, window: int) -> list[list[bool]]:
    """Covered units of every text, by comparing all windows."""
    units = [split(t) for t in texts]
    count = Counter(tuple(u[i:i + window]) for u in units for i in range(len(u) - window + 1))
    out = []
    for u in units:
        hit = [False] * len(u)
        for i in range(len(u) - window + 1):
            if count[tuple(u[i:i + window])] > 1:
                hit[i:i + window] = [True] * window
        out.append(hit)
    return out


def simhash(text: str | None, width: int = 3) -> int:
    words = WORD.findall((text or "").translate(UP))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42)
         for i in range(max(1, len(words) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes: list, linked) -> dict:
    """Smallest reachable node of each, by trying all pairs."""
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def item_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def hits(items: list[tuple], text: str | None, width: int = 10) -> tuple[list[bool], set]:
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        for j in range(max(1, len(w) - width + 1)) if w else ():
            windows[tuple(w[j:j + width])].add("" if i is None else str(i))
    words = item_words(text)
    hit, found = [False] * len(words), set()
    for size in {len(k) for k in windows}:
        for j in range(len(words) - size + 1):
            if own := windows.get(tuple(words[j:j + size])):
                found |= own
                hit[j:j + size] = [True] * size
    return hit, found


def deduped_lines(rows: list[tuple], min_chars: int = 40, min_docs: int = 5) -> list[tuple]:
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(UP)

    holders = defaultdict(set)
    for i, t, _ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                holders[key(x)].add(-1 if i is None else i)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < min_docs or (-1 if i is None else i) == max(holders[key(x)])]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out
