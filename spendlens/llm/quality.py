"""Quality rules: document histograms against language references by Jensen-Shannon distance.

DataFrame functions only. Everything about one text is computed inside its row (arrays and
higher-order functions), so the only shuffles are the partial aggregations that sum the
references: at most one row per language.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.functions.keys import broadcast_if_small
from spendlens.llm.common import WS_CLASS, write_table

#: Frequent function words of each reference language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "was", "for", "with", "as", "it"],
    "fr": ["le", "la", "les", "de", "des", "et", "en", "un", "une", "du", "que", "est"],
    "de": ["der", "die", "das", "und", "in", "den", "von", "zu", "mit", "ist", "ein", "nicht"],
    "es": ["el", "la", "los", "de", "y", "en", "que", "un", "una", "se", "las", "por"],
}
VOCABULARY = sorted({w for words in COMMON_WORDS.values() for w in words})
#: Share of the word distance of a text without common words from which a text is rejected.
WORD_SHARE = 0.95
#: Character classes as regex classes; what none of them holds is the last class.
CHAR_CLASSES = ("a-z", "A-Z", "0-9", WS_CLASS, r".,;:!?'\"()\-", r"#*$%&|<>")
#: Patterns shared by the words and the symbols.
WORD = rf"[^{WS_CLASS}]+"
SYMBOLS = r"#*$%&|<>"


def _only(text: Column, cls: str) -> Column:
    """Code points of ``text`` in the character class."""
    return F.length(F.regexp_replace(text, f"[^{cls}]+", "")).cast("long")


def _count(found: Column, word: str) -> Column:
    return F.size(found) - F.size(F.array_remove(found, word))


def _repeat_words(d: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``words``: words inside five-word windows found twice or more.

    Windows are compared by 64-bit hash. Texts without a repeated window (most) stop at the
    hash-set test; the others sort (hash, position) and keep the positions whose neighbour
    has the same hash.
    """
    windows = F.when(F.size("words") >= 5, F.transform(
        F.sequence(F.lit(0), F.size("words") - 5),
        lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(5)]))
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.withColumn("grams", windows)
    d = d.withColumn("sorted", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.array_sort(F.transform("grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))))
    d = d.withColumn("at", F.array_sort(F.transform(F.filter(
        "sorted", lambda x, j: (x.g == F.get(F.col("sorted"), j - 1).g)
        | (x.g == F.get(F.col("sorted"), j + 1).g)), lambda x: x.i)))
    steps = F.transform("at", lambda p, j: F.least(
        F.lit(5), F.coalesce(F.get(F.col("at"), j + 1) - p, F.lit(5))))
    total = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long")))


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang") -> DataFrame:
    """One slim row per document: the base counts and both histograms."""
    t = F.coalesce(docs[text_col], F.lit(""))
    d = docs.select(docs[id_col].alias("id"), docs[lang_col].alias("lang"), t.alias("t"))
    d = d.withColumn("words", F.regexp_extract_all("t", F.lit(f"({WORD})"), 1))
    d = d.withColumn("lines", F.filter(F.split("t", "\n"), lambda x: x.rlike(f"[^{WS_CLASS}]")))
    both = [w for v in VOCABULARY for w in (v, v.capitalize())]
    d = d.withColumn("common", F.transform(F.filter("words", lambda w: w.isin(both)), F.lower))
    counts = [_only(F.col("t"), c) for c in CHAR_CLASSES]
    d = d.withColumn("seen", F.array(*counts))
    d = d.withColumn("n_chars", F.length("t").cast("long"))
    d = _repeat_words(d)
    seen = F.aggregate("seen", F.lit(0).cast("long"), lambda a, x: a + x)
    return d.select(
        "id", "lang", F.size("words").cast("long").alias("n_words"),
        (F.col("n_chars") - F.get("seen", F.lit(3))).alias("word_chars"),
        F.get("seen", F.lit(5)).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", "n_chars",
        F.concat("seen", F.array(F.col("n_chars") - seen)).alias("chars"),
        F.concat(F.array(*[_count(F.col("common"), w).cast("long") for w in VOCABULARY]),
                 F.array((F.size("words") - F.size("common")).cast("long"))).alias("commons"))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column | list[float]) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of an array of shares to reference shares."""
    ref = q if isinstance(q, Column) else F.array(*[F.lit(float(x)) for x in q])

    def half(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    terms = F.zip_with(p, ref, lambda a, b: half(a, (a + b) / 2) + half(b, (a + b) / 2))
    js = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.sqrt(F.greatest(js, F.lit(0.0)))


def references(measures: DataFrame, min_words: int = 50) -> DataFrame:
    """lang, chars, commons: the character and common-word shares of every language (any value
    of ``lang``; documents without one are a group too), summed over all its documents that
    pass the base rules and have ``min_words`` words. Sums are taken by (language, position), so the measures of a
    document are computed once and no language is a group of its own."""
    use = measures.where(~base_failed() & (F.col("n_words") >= min_words))
    nc = len(CHAR_CLASSES) + 1
    sums = (use.select("lang", F.posexplode(F.concat("chars", "commons")).alias("i", "x"))
            .groupBy("lang", "i").agg(F.sum("x").alias("x")))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("s"))  # fixed width
    whole = F.transform("s", lambda p: p.x)
    parts = rows.select("lang", F.slice(whole, 1, nc).alias("c"), F.slice(whole, nc + 1, len(VOCABULARY) + 1).alias("w"))
    total = [F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x) for c in ("c", "w")]
    parts = parts.withColumn("tc", total[0]).withColumn("tw", total[1])
    return parts.select("lang", _shares(F.col("c"), F.col("tc")).alias("chars"), _shares(F.col("w"), F.col("tw")).alias("commons"))


def word_limit(commons: Column, share: float) -> Column:
    """The largest word distance that a language allows: ``share`` of the distance of a text
    without any common word, so the limit follows the language's own reference."""
    none = [0.0] * len(VOCABULARY) + [1.0]
    return share * js_distance(F.array(*[F.lit(x) for x in none]), commons)


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str = "lang", min_words: int = 50, max_char_distance: float = 0.3,
                  word_share: float = WORD_SHARE) -> DataFrame:
    """One row per document: id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, char_distance, word_distance, kept.

    A document is kept unless the base rules fail it or one of its two distances to its
    language's reference is over the limit: ``max_char_distance`` for characters, for words
    ``word_share`` of the distance that a text without common words has (see ``word_limit``).
    Documents under ``min_words`` words are too short for a histogram and are judged by the
    base rules alone. Every language of the table has a character reference, and so have the
    documents without a language together; words are compared only where ``COMMON_WORDS`` has
    the language. Without a reference a distance is null and the base rules decide. Null and
    empty texts have zero words and fail. Repeated rows come back one by one; other columns are not read.
    """
    m = write_table(text_measures(docs, id_col, text_col, lang_col), "measures")
    refs = write_table(references(m, min_words), "references")
    listed = F.coalesce(F.col("lang").isin(list(COMMON_WORDS)), F.lit(False))
    own = refs.select(F.col("lang").alias("of"), F.col("chars").alias("ref_c"), F.when(listed, F.col("commons")).alias("ref_w"))
    own = own.withColumn("word_limit", F.when(F.col("ref_w").isNotNull(), word_limit(F.col("ref_w"), word_share)))
    d = (m.withColumn("p", _shares(F.col("chars"), F.col("n_chars")))
         .withColumn("q", _shares(F.col("commons"), F.col("n_words")))
         .join(broadcast_if_small(own, 100_000), F.col("lang").eqNullSafe(F.col("of")), "left"))
    d = d.withColumn("char_distance", F.when(F.col("ref_c").isNotNull(), js_distance(F.col("p"), F.col("ref_c"))))
    d = d.withColumn("word_distance", F.when(F.col("ref_w").isNotNull(), js_distance(F.col("q"), F.col("ref_w"))))
    far = (F.col("n_words") >= min_words) & (F.coalesce(F.col("char_distance") > max_char_distance, F.lit(False))
                                            | F.coalesce(F.col("word_distance") > F.col("word_limit"), F.lit(False)))
    return (d.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & ~far)
            .select(F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols",
                    "n_dup_lines", "n_repeat_words", "base_failed", "char_distance",
                    "word_distance", "word_limit", "kept"))


def js_distance_of(p: list[float], q: list[float]) -> float:
    """The same distance in plain Python, for tests."""
    js = 0.0
    for a, b in zip(p, q, strict=True):
        m = (a + b) / 2
        js += (a * math.log2(a / m) if a else 0) + (b * math.log2(b / m) if b else 0)
    return math.sqrt(max(js / 2, 0.0))
