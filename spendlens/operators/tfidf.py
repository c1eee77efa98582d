"""TF-IDF blocks as long tables (TXT-1..10).

A block turns a text into counted terms, fits ``(term, df, idf)`` on training rows and
weighs any rows with the frozen vocabulary. Fixed formulas (must equal the reference's
vectoriser):

    idf    = ln((N + 1) / (df + 1)) + 1          (smoothed, N = training documents)
    weight = (1 + ln(tf)) * idf                   (sublinear tf)
    row L2 normalisation inside each block; terms outside the vocabulary are ignored.

Terms are counted inside their row, over Arrow batches: a whole text yields its distinct
terms with their counts, so no exploded duplicates and no shuffle come before the document
frequencies. A held vocabulary weighs texts in place; a larger one is joined, and then the
entries and the row norms shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import compress, islice, pairwise

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from spendlens.functions.text import WORD_TOKEN, fold_accents
from spendlens.session import bounded_batches, write_table

TOKEN = regex.compile(WORD_TOKEN)
ASCII_TOKEN = re.compile(r"[A-Za-z0-9_]{2,}")  # the same for a text of ASCII
#: Entries a worker gathers before it hands them on, and distinct terms it sums up at once.
PIECE_ENTRIES, HELD_SUMS = 1 << 16, 1 << 18
MAX_HELD_TERMS = 4_000_000  # 64 MB of keys and weights


@dataclass(frozen=True)
class TextBlock:
    name: str
    column: str
    analyzer: str          # "word" or "char_wb"
    min_df: int
    strip_accents: bool
    ngram_max: int = 2     # word analyzer
    char_min: int = 3      # char_wb analyzer
    char_max: int = 5


# The three text blocks of the reference's feature union.
WORD = TextBlock("word", "text", "word", min_df=2, strip_accents=True)
ITEM = TextBlock("item", "item_key", "word", min_df=1, strip_accents=True)
CHAR = TextBlock("char", "text", "char_wb", min_df=1, strip_accents=False)
BLOCKS = (WORD, ITEM, CHAR)


def counted_terms(text: str | None, block: TextBlock) -> Counter:
    """Terms of one text with their counts."""
    if not text:
        return Counter()
    if block.strip_accents:
        text = fold_accents(text)
    if block.analyzer == "word":
        tokens = (ASCII_TOKEN if text.isascii() else TOKEN).findall(text)
        out = Counter(tokens)
        if block.ngram_max > 1:
            out.update(map(" ".join, pairwise(tokens)))
        return out
    out: Counter = Counter()
    for word, n in counted_words(text).items():
        grams = char_grams(word, block.char_min, block.char_max)
        if n == 1:
            out.update(grams)
        else:
            for g in grams:
                out[g] += n
    return out


def counted_words(text: str | None) -> Counter:
    """The words between spaces with their counts, whose n-grams are those of the text."""
    return Counter(w for w in text.split(" ") if w) if text else Counter()


def grams_of(word: str, least: int, most: int) -> tuple:
    """The n-grams of a padded word."""
    padded = f" {word} "
    return tuple(padded[i:i + size] for size in range(least, max(least, min(most, len(padded))) + 1)
                 for i in range(max(1, len(padded) - size + 1)))


#: Words come again in other texts.
char_grams = lru_cache(maxsize=1 << 16)(grams_of)


def term_counts(df: DataFrame, block: TextBlock) -> DataFrame:
    """(row_id, term, tf), counted inside each row. Entries leave a worker in pieces, so it
    holds those of a few texts however many texts come at once."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            rows, terms, tfs = [], [], []
            for i in range(batch.num_rows):
                own = counted_terms(texts[i].as_py(), block)
                rows.extend([i] * len(own))
                terms.extend(own.keys())
                tfs.extend(own.values())
                if len(terms) >= PIECE_ENTRIES or (terms and i + 1 == batch.num_rows):
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows)), pa.array(terms, pa.string()), pa.array(tfs, pa.int64())],
                        ["row_id", "term", "tf"])
                    rows, terms, tfs = [], [], []

    rows = df.select("row_id", block.column)
    schema = ST.StructType([rows.schema["row_id"], ST.StructField("term", ST.StringType()),
                            ST.StructField("tf", ST.LongType())])
    return rows.mapInArrow(run, schema)


def term_frequencies(df: DataFrame, block: TextBlock) -> DataFrame:
    """(term, df): in how many rows a term occurs. Each task sums its own texts first,
    ``HELD_SUMS`` terms at a time."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            texts = batch.column(0)
            for i in range(batch.num_rows):
                sums.update(counted_terms(texts[i].as_py(), block).keys())
                if len(sums) >= HELD_SUMS:
                    yield from pieces(sums)
                    sums.clear()
        yield from pieces(sums)

    def pieces(sums: Counter) -> Iterator[pa.RecordBatch]:
        entries = iter(sums.items())
        while some := list(islice(entries, PIECE_ENTRIES)):
            terms, dfs = zip(*some, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array(dfs, pa.int64())], ["term", "df"])

    # Dealt out before the sum: a second map-side sum would hold nearly every term again.
    return (df.select(block.column).mapInArrow(run, "term string, df bigint")
            .repartition("term").groupBy("term").agg(F.sum("df").alias("df")))


def idf(n_docs: int, df: Column) -> Column:
    return F.log((F.lit(n_docs) + 1) / (df + 1)) + 1


def fit_vocabulary(train: DataFrame, block: TextBlock, n_docs: int | None = None) -> DataFrame:
    """(term, df, idf) over the training documents; terms with df < min_df are cut."""
    n = n_docs if n_docs is not None else train.count()
    vocab = term_frequencies(train, block).where(F.col("df") >= block.min_df)
    return vocab.withColumn("idf", idf(n, F.col("df")))


def weigh(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(row_id, term, weight): sublinear tf x idf over in-vocabulary terms, L2-normalised
    per row."""
    raw = counts.join(vocab.select("term", "idf"), "term").select(
        "row_id", "term", ((1 + F.log(F.col("tf"))) * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("row_id")))
    return raw.select("row_id", "term", (F.col("w") / norm).alias("weight"))


def held_vocabulary(vocab: DataFrame):
    """(keys, idf) as a broadcast, sorted by the terms' 64-bit hash, where the vocabulary's
    counted size is within MAX_HELD_TERMS and no two terms share a hash; else None."""
    if vocab.count() > MAX_HELD_TERMS:
        return None
    own = vocab.select(F.xxhash64("term").alias("key"), "idf").toArrow()
    key, weight = (own.column(i).to_numpy() for i in (0, 1))
    keys, first = np.unique(key.view(np.uint64), return_index=True)
    return vocab.sparkSession.sparkContext.broadcast((keys, weight[first])) if len(keys) == len(key) else None


def raw_weights(text: str | None, block: TextBlock, keys: np.ndarray, weight: np.ndarray) -> tuple[list, np.ndarray]:
    """The vocabulary's terms in a text, and their weights before the norm."""
    own = counted_terms(text, block)
    if not own or not len(keys):
        return [], np.zeros(0)
    key = np.fromiter((xxhash.xxh64_intdigest(t, 42) for t in own), np.uint64, len(own))
    at = np.searchsorted(keys, key)
    at[at == len(keys)] = 0
    hit = keys[at] == key
    tf = np.fromiter(own.values(), np.float64, len(own))
    return list(compress(own, hit.tolist())), ((1 + np.log(tf)) * weight[at])[hit]


def weigh_in_place(df: DataFrame, block: TextBlock, held) -> DataFrame:
    """``weigh`` where the vocabulary is held: a map over texts, no entry is shuffled. Rows of
    one row_id share a norm, so ids that come again get theirs from a sum first."""
    bounded_batches(df.sparkSession)
    rows = df.select("row_id", block.column)
    again = (rows.groupBy("row_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("row_id").alias("again")))

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [raw_weights(x.as_py(), block, *held.value)[1] for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([float(w @ w) for w in own])], ["row_id", "q"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, norms = batch.columns
            at, terms, weights = [], [], []
            for i in range(batch.num_rows):
                own, w = raw_weights(texts[i].as_py(), block, *held.value)
                at.extend([i] * len(own))
                terms.extend(own)
                norm = norms[i].as_py()
                weights.append(w / (np.sqrt(w @ w) if norm is None else norm) if len(w) else w)
                if len(terms) >= PIECE_ENTRIES or (terms and i + 1 == batch.num_rows):
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), pa.array(terms, pa.string()),
                                                      pa.array(np.concatenate(weights))], ["row_id", "term", "weight"])
                    at, terms, weights = [], [], []

    id_field = rows.schema["row_id"]
    if again.isEmpty():
        ready = rows.withColumn("norm", F.lit(None).cast("double"))
    else:
        shared = (rows.join(again, F.col("row_id").eqNullSafe(F.col("again")), "left_semi")
                  .mapInArrow(squares, ST.StructType([id_field, ST.StructField("q", ST.DoubleType())]))
                  .groupBy(F.col("row_id").alias("again")).agg(F.sqrt(F.sum("q")).alias("norm")))
        ready = rows.join(shared, F.col("row_id").eqNullSafe(F.col("again")), "left").drop("again")
    return ready.mapInArrow(run, ST.StructType([id_field, ST.StructField("term", ST.StringType()),
                                                ST.StructField("weight", ST.DoubleType())]))


def tfidf(train: DataFrame, block: TextBlock, apply_to: DataFrame | None = None) -> DataFrame:
    """Fit on ``train`` and weight ``apply_to`` (default: the training rows). A vocabulary of
    counted bounded size is broadcast and the texts are mapped in place; beyond the bound
    entries are joined to the vocabulary table."""
    rows = train if apply_to is None else apply_to
    vocab = write_table(fit_vocabulary(train, block), "vocabulary")
    held = held_vocabulary(vocab)
    return weigh(term_counts(rows, block), vocab) if held is None else weigh_in_place(rows, block, held)
