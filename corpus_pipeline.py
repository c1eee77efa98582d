"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, packing. Each stage reads what its predecessor wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import decontaminate, langid, line_dedup, packing, simhash
from spendlens.llm.common import spare_name, text_hash
from spendlens.llm.queries import tokenizer_path
from spendlens.session import scratch_path
from spendlens.sources.tables import read_table


def _with_text(docs: DataFrame, out: DataFrame, text) -> DataFrame:
    """The columns of ``docs`` from struct ``row`` with the new text; n_chars follows it."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go (no text, no letter, or a
    margin too narrow to tell two languages apart)."""
    out = langid.identify_language(docs)
    return out.where(~F.col("rejected")).select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents share stay in one of them. All documents stay."""
    return _with_text(docs, line_dedup.dedup_lines(docs), F.col("kept.text"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the smallest id (among
    equal ids the one with the smallest text hash; equal rows count once)."""
    groups = simhash.simhash_groups(docs, extra=[text_hash().alias("th")])
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th"))
    stay = (groups.groupBy(group.alias("g")).agg(first.alias("f"))
            .select(F.col("f.doc_id").alias("kid"), F.col("f.th").alias("kth")))
    th = spare_name(docs, "th")
    own = docs.withColumn(th, text_hash())
    kept = own.join(stay, own["doc_id"].eqNullSafe(stay["kid"]) & (own[th] == stay["kth"]), "left_semi")
    return kept.dropDuplicates(["doc_id", th]).select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_benchmark_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans that occur in benchmark items are cut out; documents of which more than 80 %
    of the words are hit go. All others stay."""
    out = decontaminate.scan_benchmark(docs, read_table(spark, sf_dir, "benchmark"), cut=True)
    return _with_text(docs, out.where(~decontaminate.over_limits(0.8)), F.col("cut"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, packed: one row per piece with its token ids."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_shared_lines),
    ("simhash_dedup", keep_one_of_near_copies),
    ("decontamination", remove_benchmark_spans),
    ("packing", pack_sequences),
]

#: Compression, XXH64 and the tokenizer are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline/{uuid.uuid4().hex}/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
