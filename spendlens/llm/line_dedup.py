"""Line dedup: lines that many documents share stay in one document only.

Lines are exploded with their document, hashed (128 bits of the normalised line), the
distinct documents of each hash are counted by a partial aggregation, and the hashes over
the threshold are joined back to their documents, where the kept lines are put together
again by position. A line that a third of all documents hold is one row per document in
the pre-aggregation and is split by the adaptive skew join; no task sees all its holders.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import WS_BYTES, bounded_batches, list_array, release, text_hash, to_bytes, write_table

KEYS_TYPE = "array<struct<h1:bigint,h2:bigint>>"
KEPT_TYPE = "struct<text:string,n_lines:bigint,n_dropped:bigint>"


def line_key(line: bytes) -> bytes:
    """The line without white space at either end, A-Z lower-cased."""
    return line.strip(WS_BYTES).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars:
        return False
    return key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars


def _pairs(digests: list[bytes]) -> pa.Array:
    both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
    return pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["h1", "h2"])


def keys_udf(min_chars: int):
    """Hashes of the distinct keys of a text that are long enough to be judged."""
    @F.arrow_udf(KEYS_TYPE)
    def keys(texts: pa.Array) -> pa.Array:
        release()
        found, lengths = [], []
        for raw in to_bytes(texts):
            own = {xxhash.xxh3_128_digest(k) for k in map(line_key, (raw or b"").split(b"\n"))
                   if _long_enough(k, min_chars)}
            found.extend(own)
            lengths.append(len(own))
        return list_array(_pairs(found), lengths)
    return keys


def keep_udf():
    """The text without the lines whose key hash is listed."""
    @F.arrow_udf(KEPT_TYPE)
    def keep(texts: pa.Array, drops: pa.Array) -> pa.Array:
        drops = drops.combine_chunks() if isinstance(drops, pa.ChunkedArray) else drops
        flat = drops.flatten()
        both = np.stack([flat.field(i).to_numpy(zero_copy_only=False).astype("<i8")
                         for i in (0, 1)], 1) if len(flat) else np.zeros((0, 2), "<i8")
        counts = drops.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        at, out, n_lines, n_dropped = 0, [], [], []
        for raw, n in zip(to_bytes(texts), counts.tolist(), strict=True):
            raw = raw or b""
            lines = raw.count(b"\n") + 1
            n_lines.append(lines)
            if n:
                bad = {both[i].tobytes() for i in range(at, at + n)}
                at += n
                kept = [x for x in raw.split(b"\n")
                        if xxhash.xxh3_128_digest(line_key(x)) not in bad]
                raw, n = b"\n".join(kept), lines - len(kept)
            out.append(raw)
            n_dropped.append(n)
        return pa.StructArray.from_arrays(
            [pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
             pa.array(n_dropped, pa.int64())], ["text", "n_lines", "n_dropped"])
    return keep


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """One row per row of ``docs``: its columns as struct ``row``, and struct ``kept``
    (text, n_lines, n_dropped).

    A line's key is the line stripped of white space with A-Z lower-cased. A key of at
    least ``min_chars`` code points in at least ``min_docs`` distinct documents loses all
    its lines except those of the largest id holding it.

    Null or empty text is one empty line and comes back as an empty text. Rows with a null
    id count together as one document that is smaller than every id. Repeated rows (one
    id) are one document in the counts, and each comes back. Other columns pass through
    untouched, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                       docs[id_col].alias("id"), docs[text_col].alias("t"))
    base = base.withColumn("th", text_hash("t"))
    lines = write_table(
        base.withColumn("k", F.explode(keys_udf(min_chars)("t"))).select("id", "th", "k.h1", "k.h2"),
        "lines")
    # A written table: the join below is then between two exchanges, so a hot line is split.
    shared = write_table(
        lines.groupBy("h1", "h2")
        .agg((F.count_distinct("id") + F.max(F.col("id").isNull().cast("long"))).alias("n"),
             F.max("id").alias("last"))
        .where(F.col("n") >= min_docs).select("h1", "h2", "last"),
        "shared-lines")
    drops = (lines.join(shared, ["h1", "h2"])
             .where(F.col("id").isNull() | (F.col("id") < F.col("last")))
             .groupBy("id", "th").agg(F.collect_set(F.struct("h1", "h2")).alias("drops")))
    drops = drops.select(F.col("id").alias("did"), F.col("th").alias("dth"), "drops")
    return (base.join(drops, F.col("id").eqNullSafe(F.col("did")) & (F.col("th") == F.col("dth")),
                      "left")
            .select("row", keep_udf()("t", F.col("drops").cast(KEYS_TYPE)).alias("kept")))
