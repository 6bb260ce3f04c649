"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text becomes ``len(FEATURES)`` statistics (logarithms of sizes, log-odds of shares). Per class the
mean and covariance of the labelled rows are fitted from sums over all of them; a covariance is
shrunk towards the pooled one and its diagonal. A score is the logistic of the difference of the
two classes' log-densities (Mahalanobis distance by a cached Cholesky factor, plus the
log-determinant and the class's share).

Scale: statistics and scores are map-only passes over the texts. Fitting joins labels with
statistics, not texts, and the sums are grouped by matrix cell, so the driver receives
2 x (1 + d + d*d) numbers however many rows are labelled.

Defined results: null and empty texts have the statistics of no words and get a score like any other;
labels that are null or not 0 or 1 and labels without a document are ignored; a label counts once per
(row, label) pair, so repeated rows count again. If a class has no labelled row, every score is the
share of label 1 (0.5 without labels). Extra columns are ignored or, in ``keep_good``, kept.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release, save

FEATURES = (
    "words",
    "word_length",
    "letters",
    "capitals",
    "digits",
    "marks",
    "odd_marks",
    "bars",
    "shouts",
    "spaces",
    "lines",
    "line_words",
    "repeated_lines",
    "distinct_words",
    "top_word",
    "stutter",
    "short_words",
    "marked_words",
    "sentence_ends",
    "all_capitals",
)
SHRINK_POOLED = 0.10
SHRINK_DIAGONAL = 0.05


def _odds(part: float, whole: float) -> float:
    """Log-odds of a share, kept finite and steady for short texts."""
    return math.log((part + 0.5) / (whole - part + 0.5)) if whole > 0 else 0.0


_MARKS = frozenset(b"""!"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~""")
_ODD = frozenset(b"#$%&*+<=>@\\^_`{|}~")
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC0:] = True  # a multi-byte character counts by its first byte
_CLASS = {
    "capitals": _UPPER,
    "letters": _LETTER,
    "digits": np.isin(np.arange(256), np.arange(48, 58)),
    "marks": np.isin(np.arange(256), list(_MARKS)),
    "odd_marks": np.isin(np.arange(256), list(_ODD)),
    "bars": np.arange(256) == ord("|"),
    "shouts": np.arange(256) == ord("!"),
    "spaces": np.isin(np.arange(256), [9, 10, 11, 12, 13, 32]),
}
_TABLE = np.array([_CLASS[k] for k in _CLASS], np.int64)
_HEAD = np.array([not 0x80 <= b < 0xC0 for b in range(256)], np.int64)  # first byte of a character


def statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of ``FEATURES``."""
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(byte @ _HEAD)
    count = dict(zip(_CLASS, (_TABLE @ byte).tolist()))
    words = text.split()
    n = len(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = Counter(words)
    top = max(repeats.values(), default=0)
    stutter = sum(map(bytes.__eq__, words, words[1:]))
    short = sum(len(w) <= 3 for w in words)
    ends = sum(w[-1] in b".!?" for w in words)
    marked = sum(w[-1] in _ODD or w[-1] == 33 for w in words)
    loud = sum(map(bytes.isupper, words))
    return [
        math.log1p(n),
        math.log1p((chars - count["spaces"]) / n) if n else 0.0,
        _odds(count["letters"], chars),
        _odds(count["capitals"], max(count["letters"], count["capitals"])),
        _odds(count["digits"], chars),
        _odds(count["marks"], chars),
        _odds(count["odd_marks"], chars),
        _odds(count["bars"], chars),
        _odds(count["shouts"], chars),
        _odds(count["spaces"], chars),
        math.log1p(len(lines)),
        math.log1p(n / len(lines)) if lines else 0.0,
        _odds(len(lines) - len(set(lines)), len(lines)),
        math.log((len(repeats) + 1) / (n + 1)),
        math.log((top + 1) / (n + 2)),
        _odds(stutter, n),
        _odds(short, n),
        _odds(marked, n),
        _odds(ends, n),
        _odds(loud, n),
    ]


@F.arrow_udf(T.ArrayType(T.DoubleType()))
def _statistics(column: pa.Array) -> pa.Array:
    rows = [statistics(bytes(x.as_buffer()) if x.is_valid else b"") for x in column]
    release()
    return pa.array(rows, pa.list_(pa.float64()))


def document_statistics(text: Column) -> Column:
    return _statistics(text.cast("binary"))


class QuadraticDiscriminant:
    """Two Gaussian classes with shrunk covariances; Cholesky factors are computed once."""

    def __init__(self, n: np.ndarray, total: np.ndarray, outer: np.ndarray):
        """Row counts [2], sums [2, d] and sums of outer products [2, d, d] of the labelled rows."""
        self.n = n
        self.prior = float(n[1] / n.sum()) if n.sum() else 0.5
        self.classes = []
        if not n.all():
            return
        mean = total / n[:, None]
        spread = outer / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
        pooled = (spread * n[:, None, None]).sum(axis=0) / n.sum()
        eye = np.eye(mean.shape[1])
        for k in (0, 1):
            cov = (1 - SHRINK_POOLED) * spread[k] + SHRINK_POOLED * pooled
            cov = (1 - SHRINK_DIAGONAL) * cov + SHRINK_DIAGONAL * eye * np.diag(pooled) + 1e-6 * eye
            factor = np.linalg.cholesky(cov)
            self.classes.append((mean[k], np.linalg.inv(factor), 2 * np.log(np.diag(factor)).sum(), math.log(n[k] / n.sum())))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of statistics."""
        if not self.classes:
            return np.full(len(x), self.prior)
        density = [share - 0.5 * (log_det + (((x - mean) @ half.T) ** 2).sum(axis=1)) for mean, half, log_det, share in self.classes]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def _sums(batches):
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        label = batch.column("label").to_numpy(zero_copy_only=False)
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for k in (0, 1):
            own = x[label == k]
            total[k] += np.r_[len(own), own.sum(axis=0), (own.T @ own).ravel()]
    label, cell = np.nonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(label.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total[label, cell])], ["label", "cell", "v"]
    )


def fit(rows: DataFrame) -> QuadraticDiscriminant:
    """Fit from ``rows`` (label int 0 or 1, x array of statistics)."""
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    found = rows.select("label", "x").mapInArrow(_sums, "label int, cell int, v double")
    for r in found.groupBy("label", "cell").agg(F.sum("v").alias("v")).collect():
        total[r["label"], r["cell"]] = r["v"]
    return QuadraticDiscriminant(total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d))


def _labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """``stats`` (id, x) with the labels of their ids."""
    marks = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("id"), F.col("quality").cast("int").alias("label"))
    return stats.join(marks.distinct(), "id").select("label", "x")


def _scorer(model: QuadraticDiscriminant):
    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
        return pa.array(model.score(values), pa.float64())

    return score


def classify(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) per row; labels are learned only from rows where ``learn`` (on the id) holds."""
    stats = save(docs.select(F.col(id_col).alias("id"), document_statistics(F.col(text_col)).alias("x")), "quality")
    model = fit(_labelled(stats.withColumnRenamed("id", id_col).where(learn).withColumnRenamed(id_col, "id"), labels))
    scored = stats.select(F.col("id").alias("doc_id"), _scorer(model)("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` with a score of at least 0.5, learned from all labels; columns are unchanged.

    Rows and statistics are written once, so the texts are neither read twice nor shuffled.
    """
    stats = save(docs.select(F.struct("*").alias("doc"), document_statistics(F.col(text_col)).alias("x")), "quality")
    model = fit(_labelled(stats.select(F.col(f"doc.{id_col}").alias("id"), "x"), labels))
    return stats.where(_scorer(model)("x") >= 0.5).select("doc.*")
