"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.session import bounded_batches, scratch_path  # noqa: F401

#: The white space that separates words: space and U+0009 to U+000D.
WS_BYTES = b" \t\n\x0b\x0c\r"
WS_CLASS = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(col: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def text_hash(text_col: str = "text") -> Column:
    """64-bit content hash of a text; null and empty differ."""
    return F.xxhash64(F.col(text_col), F.col(text_col).isNull())


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage with files that every executor and the driver share, so a lost
    executor never replays what came before, and shuffle files that only served this
    table can be cleaned.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    del df
    release_shuffles(spark)
    return spark.read.parquet(path)


class Scratch:
    """Tables of one computation below ``spark.checkpoint.dir`` that go together once
    what was computed from them has itself been written."""

    def __init__(self, spark, name: str):
        self.spark, self.path, self.paths = spark, scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}"), {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """A name may come again; ``drop`` then means the last table of that name."""
        path = self.paths[name] = f"{self.path}/{uuid.uuid4().hex}-{name}"
        df.write.option("compression", "zstd").parquet(path)
        del df
        release_shuffles(self.spark)
        return self.spark.read.parquet(path)

    def drop(self, name: str) -> None:
        """Remove one table, once all that was computed from it has been written."""
        self._delete(self.paths.pop(name))

    def remove(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark) -> None:
    """Let Spark's cleaner see plans that nothing refers to, so that their shuffle files go."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_HELD: dict = {}


def held(key, build):
    """``build()``, made once in this Python worker and kept while its tasks ask for ``key``.
    One object at a time: workers go on to other stages, and what those do not ask for is let go."""
    if key not in _HELD:
        release()
        _HELD[key] = build()
    return _HELD[key]


def release() -> None:
    """Let go of the object a former stage left in this worker, and give its memory back."""
    if _HELD:
        _HELD.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def spare_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or with underscores appended until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def to_bytes(texts: pa.Array) -> list:
    """The UTF-8 bytes of each text; None stays None."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if pa.types.is_large_string(texts.type):
        return texts.cast(pa.large_binary()).to_pylist()
    return texts.cast(pa.binary()).to_pylist()


def list_array(values: pa.Array, lengths) -> pa.Array:
    """A list array whose rows have ``lengths`` values each."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def merged_runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals as maximal runs (touching intervals join)."""
    if len(starts) == 0:
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    first = np.ones(len(starts), bool)
    first[1:] = starts[1:] > ends[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(starts)) - 1
    return starts[at], ends[last]


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x
