"""Text normalisation and tokenisation.

Normalisation and n-grams are Column expressions. Accent folding needs the whole of
Unicode's decompositions, which no built-in function has, and runs over Arrow batches.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (must equal the reference's behaviour):
#   whitespace = every character Python's str.isspace() accepts; runs collapse to one space
#   word token = maximal run of two or more word characters (letters, digits, underscore)
#   word n-grams = 1 and 2, joined by one space
#   char_wb n-grams = 3 to 5, inside each space-padded word
# The class below lists Python's whitespace explicitly so Java and RE2 agree with it.
WHITESPACE_RUN = r"[\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}]+"
WHITESPACE_ONLY = r"^[\t\n\x{0B}\f\r\x{1C}-\x{1F}\x{85}\p{Z}]*$"
WORD_TOKEN = r"[\p{L}\p{N}_]{2,}"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(c) -> Column:
    """NULL -> '', lower case, whitespace runs -> one space, stripped.

    Collapsing runs first makes the final ``trim`` (which removes 0x20 only) equivalent
    to a full whitespace strip.
    """
    lowered = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.trim(F.regexp_replace(lowered, WHITESPACE_RUN, " "))


def build_text(item, description) -> Column:
    """Normalised item name and description joined by one space, stripped."""
    return F.trim(F.concat(normalize_text(item), F.lit(" "), normalize_text(description)))


def is_blank(c) -> Column:
    """True when the value is NULL, empty or whitespace only (Python ``str.strip() == ''``)."""
    return F.coalesce(_col(c), F.lit("")).rlike(WHITESPACE_ONLY)


def fold_accents(text: str) -> str:
    """NFKD without combining marks, over all of Unicode (ligatures and widths included)."""
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKD", text)
    for mark in filter(unicodedata.combining, set(text)):
        text = text.replace(mark, "")
    return text


def strip_accents(c) -> Column:
    """``fold_accents`` on a column, vectorised over Arrow batches."""
    @F.arrow_udf("string")
    def fold(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else fold_accents(t) for t in texts.to_pylist()], pa.string())
    return fold(_col(c))


def word_tokens(c) -> Column:
    """Maximal runs of >= 2 word characters, in text order."""
    return F.regexp_extract_all(_col(c), F.lit(WORD_TOKEN), 0)


def word_ngrams(tokens, n_max: int = 2) -> Column:
    """Token 1-grams followed by 2-grams (adjacent pairs joined by a space)."""
    tok = _col(tokens)
    if n_max == 1:
        return tok
    if n_max != 2:
        raise ValueError("only 1- and 2-grams are supported")
    # adjacent pairs: zip the tokens with themselves shifted by one (pass a column, not a
    # tokeniser expression, so nothing is recomputed per element)
    shifted = F.slice(F.concat(tok, F.array(F.lit(None).cast("string"))), 2, F.size(tok) + 1)
    pairs = F.zip_with(tok, shifted, lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    return F.concat(tok, F.filter(pairs, lambda s: s.isNotNull()))


def char_wb_ngrams(c, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams inside word boundaries.

    Every whitespace-separated word is padded with one space on each side; for each n
    from ``n_min`` up to ``min(n_max, padded length)`` all substrings of length n are
    emitted (a padded word shorter than ``n_min`` is emitted once, whole).
    """
    words = F.filter(F.split(_col(c), " "), lambda w: F.length(w) > 0)
    padded = F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" ")))

    def grams_of(p: Column) -> Column:
        plen = F.length(p)
        top = F.greatest(F.least(F.lit(n_max), plen), F.lit(n_min))
        return F.flatten(F.transform(
            F.sequence(F.lit(n_min), top),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.greatest(plen - n + 1, F.lit(1))),
                lambda i: p.substr(i, n),
            ),
        ))

    return F.flatten(F.transform(padded, grams_of))
