"""Quality classifier: regularised quadratic discriminant over document statistics.

Every text becomes a short vector of transformed statistics (logarithms of counts, arcsines
of shares). Labelled rows give one Gaussian per class: mean and covariance from moments
that Spark sums, the covariance shrunk towards the pooled one and towards a multiple of the
identity. The score of any row is the logistic of the difference of the two log densities
(Mahalanobis distances by the cached inverse Cholesky factors) and of the log prior.

The statistics are one Arrow pass over the texts; what is summed for the fit is one short
row per class and moment, whatever the size of the tables.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlens.llm.common import WS_BYTES, bounded_batches, to_bytes, write_table

#: Weight of the pooled covariance, and of the mean variance on the diagonal.
POOLED, RIDGE = 0.1, 0.01
#: Score from which a row counts as good.
GOOD_FROM = 0.3
#: Characters, words and lines that every share is taken over besides the text's own, so that
#: the shares of a short text are no more extreme than it can bear out.
LEAST_CHARS, LEAST_WORDS, LEAST_LINES = 64, 16, 4
#: Bytes of a text that are split into words at once.
PIECE_BYTES = 1 << 20

STATISTICS = ("words", "word_length", "letters", "capitals", "digits", "punctuation", "symbols",
              "space", "distinct_words", "commonest_word", "repeated_lines", "words_per_line",
              "bare_words", "entropy")
_LETTER, _CAPITAL, _DIGIT, _PUNCT, _SYMBOL, _SPACE, _INSIDE = 1, 2, 3, 4, 5, 6, 7


def _classes() -> np.ndarray:
    """Character class of every byte; continuation bytes are inside a character, and all
    characters beyond ASCII count as letters."""
    out = np.zeros(256, np.uint8)
    out[0xC0:] = _LETTER
    out[0x80:0xC0] = _INSIDE
    for chars, cls in ((b"abcdefghijklmnopqrstuvwxyz", _LETTER), (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _CAPITAL),
                       (b"0123456789", _DIGIT), (b".,;:!?'\"()-", _PUNCT), (WS_BYTES, _SPACE)):
        out[np.frombuffer(chars, np.uint8)] = cls
    out[:128][out[:128] == 0] = _SYMBOL
    return out


_CLASS_OF = _classes()


def _pieces(raw: bytes):
    """The text in pieces of about ``PIECE_BYTES`` that end before a white space."""
    at = 0
    while at < len(raw):
        end = min(at + PIECE_BYTES, len(raw))
        while end < len(raw) and raw[end] not in WS_BYTES:
            end += 1
        yield raw[at:end]
        at = end


def statistics(raw: bytes) -> list[float]:
    """The transformed statistics of one text; a text without words gives finite numbers."""
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256, np.int64)
    kinds = np.bincount(_CLASS_OF, bytes_, 8)
    chars = max(1.0, kinds.sum() - kinds[_INSIDE])
    seen: Counter = Counter()
    for piece in _pieces(raw):
        seen.update(piece.split())
    words = sum(seen.values())
    bare = sum(n for w, n in seen.items() if not any(_CLASS_OF[b] in (_LETTER, _CAPITAL, _INSIDE) for b in w[:64]))
    lines = Counter(x for x in raw.split(b"\n") if x.strip())
    n_lines = sum(lines.values())
    share = bytes_[bytes_ > 0] / max(1, len(raw))
    letters = kinds[_LETTER] + kinds[_CAPITAL]

    def angle(part, whole, least):
        return float(np.arcsin(np.sqrt(min(1.0, part / (whole + least)))))

    return [float(np.log1p(words)), float(np.log1p((chars - kinds[_SPACE]) / max(1, words))),
            angle(letters, chars, LEAST_CHARS), angle(kinds[_CAPITAL], letters, LEAST_CHARS),
            angle(kinds[_DIGIT], chars, LEAST_CHARS), angle(kinds[_PUNCT], chars, LEAST_CHARS),
            angle(kinds[_SYMBOL], chars, LEAST_CHARS), angle(kinds[_SPACE], chars, LEAST_CHARS),
            angle(len(seen), words, LEAST_WORDS), angle(max(seen.values(), default=0), words, LEAST_WORDS),
            angle(n_lines - len(lines), n_lines, LEAST_LINES), float(np.log1p(words / max(1, n_lines))),
            angle(bare, words, LEAST_WORDS), float(-(share * np.log2(share)).sum())]


def statistics_udf():
    @F.arrow_udf("array<double>")
    def measure(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(raw or b"") for raw in to_bytes(texts)], pa.list_(pa.float64()))
    return measure


def held_out(id_col: Column) -> Column:
    """True for documents whose labels are never learned: crc32 of the id's text mod 5 is 0.
    A null id has no label and is not held out."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors of the regularised covariances, their log
    determinants and log priors; ``constant`` stands in where a class has no rows."""
    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row of ``x``."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        dens = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.factors[k].T
            dens.append(self.log_priors[k] - 0.5 * (self.log_dets[k] + (z * z).sum(1)))
        return 1.0 / (1.0 + np.exp(np.clip(dens[0] - dens[1], -700, 700)))


def discriminant(n: np.ndarray, total: np.ndarray, outer: np.ndarray, pooled: float = POOLED,
                 ridge: float = RIDGE) -> Discriminant:
    """The classifier from the counts (2), sums (2, d) and sums of products (2, d, d).

    Covariance of class k: ``(1 - pooled) * S_k + pooled * S``, then ``(1 - ridge)`` of it
    plus ``ridge`` times the variances of S on the diagonal, so every factor exists, for a
    class of one row or a constant statistic as well. Without rows of one class the score
    is the other class for all; without any rows it is one half.
    """
    d = total.shape[1]
    if not n.all():
        constant = 0.5 if not n.any() else float(n[1] > 0)
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), np.zeros(2), constant)
    means = total / n[:, None]
    scatter = outer - n[:, None, None] * means[:, :, None] * means[:, None, :]
    whole = scatter.sum(0) / n.sum()
    floor = np.diag(np.maximum(np.diag(whole), 1e-6))
    factors, log_dets = [], []
    for k in (0, 1):
        cov = (1 - ridge) * ((1 - pooled) * scatter[k] / n[k] + pooled * whole) + ridge * floor
        low = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(low))
        log_dets.append(2 * np.log(np.diag(low)).sum())
    return Discriminant(means, np.array(factors), np.array(log_dets), np.log(n / n.sum()))


def _moments(batches):
    """Counts, sums and products per class over the rows of a task, one row per class."""
    d = len(STATISTICS)
    acc = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        y = batch.column(0).to_numpy(zero_copy_only=False)
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for k in (0, 1):
            own = x[y == k]
            acc[k] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
    yield pa.RecordBatch.from_arrays([pa.array([0, 1], pa.int32()), pa.array(acc.tolist(), pa.list_(pa.float64()))],
                                     ["y", "m"])


def fit(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        pooled: float = POOLED, ridge: float = RIDGE) -> Discriminant:
    """Fit on the rows of ``measured`` (id, held_out, x) that have a label and are not held out.

    An id with two different labels, or one that is neither 0 nor 1, teaches nothing. Equal
    statistics of a class count once, so a group of copies of any size is one observation.
    The sums are taken in tasks and met by (class, position): the driver sees
    ``2 * (1 + d + d * d)`` numbers.
    """
    own = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("y"))
    own = (own.where(F.col("id").isNotNull()).groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top"))
           .where((F.col("y") == F.col("top")) & F.col("y").isin(0, 1)).select("id", "y"))
    rows = measured.where(~F.col("held_out")).join(own, "id").select("y", "x").distinct()
    parts = rows.mapInArrow(_moments, "y int, m array<double>")
    sums = (parts.select("y", F.posexplode("m").alias("pos", "v")).groupBy("y", "pos")
            .agg(F.sum("v").alias("v")).collect())
    d = len(STATISTICS)
    acc = np.zeros((2, 1 + d + d * d))
    for r in sums:
        acc[r["y"], r["pos"]] = r["v"]
    return discriminant(acc[:, 0], acc[:, 1:1 + d], acc[:, 1 + d:].reshape(2, d, d), pooled, ridge)


def score_udf(model: Discriminant):
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
        return pa.array(model.scores(rows))
    return score


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     label_col: str = "quality", good_from: float = GOOD_FROM) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score (0 to 1), predicted (1 from ``good_from``).

    Null texts are scored like empty ones: a text without words has statistics like any
    other. Texts of any length are read whole, in pieces. Repeated rows come back one by
    one, null ids included; an empty table gives an empty result. Without labels all scores
    are 0.5, with labels of one class that class. No other column is read, whatever its name.
    """
    bounded_batches(docs.sparkSession)
    measured = write_table(docs.select(
        docs[id_col].alias("id"), held_out(docs[id_col]).alias("held_out"),
        statistics_udf()(F.coalesce(docs[text_col], F.lit(""))).alias("x")), "statistics")
    model = fit(measured, labels, id_col, label_col)
    scored = measured.withColumn("score", score_udf(model)("x"))
    return scored.select(F.col("id").alias(id_col), "held_out", "score",
                         (F.col("score") >= good_from).cast("int").alias("predicted"))
