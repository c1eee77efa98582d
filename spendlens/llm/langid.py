"""Language ID by compression: the language whose zstandard dictionary shrinks a text most.

Each learned language has a raw-content dictionary: a bounded sample of its labelled
training texts. A text is compressed in fixed blocks against every dictionary, and the
sizes of its blocks are added, so each part of it counts alike however long it is; the
smallest sum names the language, and the relative gap to the runner-up is the margin.
Texts and dictionaries are lower-cased, so capitals are no language of their own.
Prediction is a map over rows with no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlens.llm.common import bounded_batches, release, to_bytes

LETTER = regex.compile(r"\p{L}")
UNKNOWN = "und"
#: Relative gap between the two smallest outputs under which a text is rejected.
MIN_MARGIN = 0.002
#: Bytes compressed at once.
BLOCK_BYTES = 8 << 10
RESULT = "struct<lang:string,score:double,rejected:boolean>"


def held_out(id_col: Column) -> Column:
    """True for documents that are never learned from: crc32 of the id's text mod 3 is 1."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train_dictionaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       lang_col: str = "lang", sample_docs: int = 200, max_chars: int = 8192,
                       dict_bytes: int = 1 << 16) -> dict[str, bytes]:
    """Raw dictionary content per language.

    The fitting sample is bounded by its parameters: per language the ``sample_docs``
    distinct training texts that come first in the order of a hash of the text (so neither
    the order of rows, the number of copies nor the size of a source matters), each cut to
    ``max_chars`` characters from its first letter if it is longer, all together cut to the
    last ``dict_bytes`` bytes (so texts of 400 bytes or more fill a dictionary before all
    ``sample_docs`` are in). Hashes are ranked before any text moves, first in 64 parts of a
    language, then over the parts; ``row_number() <= n`` is a group limit before the shuffle, the ranked hashes (at most ``sample_docs`` per
    language) are broadcast, and copies of a chosen text meet in a partial aggregation.
    """
    usable = docs.select(docs[id_col].alias("i"), docs[lang_col].alias("l"), docs[text_col].alias("t"))
    usable = (usable.where(F.col("l").isNotNull() & F.col("t").rlike(r"\p{L}") & ~held_out(F.col("i")))
              .select("l", F.xxhash64("t").alias("o"), "t"))
    # First inside parts of a language, so that a hot one is no task of its own.
    parts = Window.partitionBy("l", F.pmod("o", F.lit(64))).orderBy("o")
    w = Window.partitionBy("l").orderBy("o")
    first = (usable.select("l", "o").distinct().withColumn("n", F.row_number().over(parts))
             .where(F.col("n") <= sample_docs).withColumn("n", F.row_number().over(w))
             .where(F.col("n") <= sample_docs))
    cut = F.when(F.length("t") <= max_chars, F.col("t")).otherwise(
        F.regexp_extract("t", rf"(?s)\p{{L}}.{{0,{max_chars - 1}}}", 0))
    rows = (usable.join(F.broadcast(first), ["l", "o"]).select("l", "n", cut.alias("t"))
            .groupBy("l", "n").agg(F.min("t").alias("t")).collect())
    texts: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["l"], -r["n"])):
        texts.setdefault(r["l"], []).append(r["t"])
    return {lang: "\n".join(t).lower().encode()[-dict_bytes:] for lang, t in texts.items()}


def classifier(dictionaries: dict[str, bytes], level: int = 6, min_margin: float = MIN_MARGIN):
    """Arrow function text -> (lang, score, rejected).

    ``score`` is the relative gap between the smallest and the second smallest sum of block
    sizes (1 with a single language). Ties take the first language by name. Null texts and
    texts without a letter are ``und`` with score 0 and rejected; so is every text if nothing
    was learned. Otherwise a text is rejected when its score is under ``min_margin``.
    """
    langs = sorted(dictionaries)

    @F.arrow_udf(RESULT)
    def classify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        coders = []  # made once a task and dropped at its end
        for lang in langs:
            content = zstandard.ZstdCompressionDict(
                dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            coders.append(zstandard.ZstdCompressor(
                dict_data=content, write_content_size=False).compress)
        for texts in batches:
            yield judged(texts, coders)

    def judged(texts: pa.Array, coders: list) -> pa.Array:
        out_l, out_s, out_r = [], [], []
        for raw in to_bytes(texts):
            text = raw.decode("utf-8", "replace") if raw else ""
            if not langs or not LETTER.search(text):
                lang, score, bad = UNKNOWN, 0.0, True
            else:
                folded = text.lower().encode()
                blocks = [folded[i:i + BLOCK_BYTES] for i in range(0, len(folded), BLOCK_BYTES)]
                sizes = [sum(len(c(b)) for b in blocks) for c in coders]
                best = min(sizes)
                lang = langs[sizes.index(best)]
                rest = sorted(sizes)[1:]
                score = 1.0 - best / rest[0] if rest else 1.0
                bad = score < min_margin
            out_l.append(lang)
            out_s.append(score)
            out_r.append(bad)
        return pa.StructArray.from_arrays(
            [pa.array(out_l, pa.string()), pa.array(out_s, pa.float64()),
             pa.array(out_r, pa.bool_())], ["lang", "score", "rejected"])
    return classify


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang", min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per row of ``docs``: its columns as struct ``row``, held_out, lang_pred,
    score, rejected.

    Learns from ``docs`` itself, leaving out the held-out ids, rows without a language and
    texts without a letter. An empty table gives an empty result; repeated rows are
    predicted one by one; a null id is not held out but, having no remainder, is learned
    from like any other row. Other columns pass through, whatever their names.
    """
    bounded_batches(docs.sparkSession)
    predict = classifier(train_dictionaries(docs, id_col, text_col, lang_col),
                         min_margin=min_margin)
    return (docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"),
                        held_out(docs[id_col]).alias("held_out"),
                        predict(docs[text_col]).alias("p"))
            .select("row", "held_out", F.col("p.lang").alias("lang_pred"),
                    F.col("p.score").alias("score"), F.col("p.rejected").alias("rejected")))
