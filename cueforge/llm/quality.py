"""Quality classifier: regularised quadratic discriminant over document statistics.

Each text becomes a vector of transformed statistics (logarithms of lengths, logits and square roots of shares). For each class the mean and covariance
come from sums over the labelled training rows; the covariance is shrunk towards its own diagonal and towards the pooled one. A score is the
logistic of the log-density difference: both Mahalanobis distances by the classes' Cholesky factors, which are computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueforge.llm.memory import lean
from cueforge.llm.words import buffers, word_spans

FEATURES = ["words", "word_length", "upper", "digits", "symbols", "bangs", "bars", "shouted", "marked", "new_words", "lines", "line_copies", "stops", "commas"]
PIECE, MOST_LABELS = 1 << 20, 200_000


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_UPPER, _LOWER, _DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(97, 123))), _table(b"0123456789")
_HIGH = _table(bytes(range(128, 256)))
_SYMBOL = _table(bytes(range(33, 127))) & ~_UPPER & ~_LOWER & ~_DIGIT & ~_table(b".,;:'!?|-()\"")
_BANG, _BAR, _STOP, _COMMA, _END = _table(b"!"), _table(b"|"), _table(b".!?"), _table(b",;:"), _table(b"\n")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each document."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of FEATURES for each text; null and empty texts are all zeros but for fixed offsets."""
    data, offsets = buffers(column)
    out, lo = [np.zeros((0, len(FEATURES)))], 0
    while lo < len(offsets) - 1:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1)
        out.append(_piece(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]))
        lo = hi
    return np.concatenate(out)


def _piece(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    h, s, e, at = word_spans(data, offsets)
    docs = len(offsets) - 1
    words, size = np.diff(at).astype(float), np.maximum(np.diff(offsets), 1).astype(float)
    of = lambda t: _sums(t[data], offsets)
    letters = np.maximum(of(_UPPER) + of(_LOWER) + of(_HIGH), 1)
    last, first = data[e - 1] if len(e) else data[:0], data[s] if len(s) else data[:0]
    loud = _UPPER[first] & (e - s > 2)
    second = data[np.minimum(s + 1, max(len(data) - 1, 0))] if len(s) else data[:0]
    owner = np.repeat(np.arange(docs), words.astype(int))
    order = np.lexsort((h, owner))
    ordered, by = h[order], owner[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (ordered[1:] != ordered[:-1]) | (by[1:] != by[:-1])
    new = np.bincount(by[fresh], minlength=docs).astype(float)
    ends = np.flatnonzero(_END[data])
    raw = data.tobytes()
    copies, lines = np.zeros(docs), np.zeros(docs)
    cut = np.searchsorted(ends, offsets)
    for d in np.flatnonzero(np.diff(cut) > 0):
        own = [x for x in raw[offsets[d] : offsets[d + 1]].split(b"\n") if x.strip()]
        lines[d], copies[d] = len(own), len(own) - len(set(own))
    w = np.maximum(words, 1)
    share = lambda n, of: np.sqrt(n / of)
    logit = lambda n, of: np.log((n + 0.5) / (np.maximum(of - n, 0) + 0.5))
    return np.stack([
        np.log1p(words), np.log(np.maximum(_sums(np.ones(len(data), bool), offsets) - words, 1) / w),
        share(of(_UPPER), letters), share(of(_DIGIT), size), share(of(_SYMBOL), size), share(of(_BANG), size), share(of(_BAR), size),
        share(_sums(loud & _UPPER[second], at), w), share(_sums(_SYMBOL[last], at), w), logit(new, w), np.log1p(lines),
        share(copies, np.maximum(lines, 1)), share(_sums(_STOP[last], at), w), share(_sums(_COMMA[last], at), w),
    ], 1)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class's count, sum and sum of products over labelled texts."""
    d = len(FEATURES)
    sums = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        y, x = batch.column(0).to_numpy(zero_copy_only=False), statistics(batch.column(1))
        for c in (0, 1):
            own = x[y == c]
            sums[c] += np.r_[len(own), own.sum(0), (own.T @ own).ravel()]
    yield pa.record_batch([pa.array([0, 1]), pa.array(sums.tolist(), pa.list_(pa.float64()))], names=["label", "sums"])


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log terms of the two classes."""

    means: np.ndarray
    factors: np.ndarray
    terms: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1."""
        if self.prior in (0.0, 1.0):
            return np.full(len(x), self.prior)
        density = [self.terms[c] - 0.5 * (((x - self.means[c]) @ self.factors[c].T) ** 2).sum(1) for c in (0, 1)]
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(sums: np.ndarray, to_diagonal: float = 0.05, to_pooled: float = 0.05) -> Discriminant:
    """From each class's count, sum and sum of products. With one class only, every score is its share."""
    d = len(FEATURES)
    n = sums[:, 0]
    prior = float(n[1] / n.sum()) if n.sum() else 0.5
    means, factors, terms = np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2)
    if not n.all():
        return Discriminant(means, factors, terms, float(round(prior)) if n.sum() else 1.0)
    means = sums[:, 1 : d + 1] / n[:, None]
    spread = [sums[c, d + 1 :].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = (n[0] * spread[0] + n[1] * spread[1]) / n.sum()
    for c in (0, 1):
        cov = (1 - to_pooled) * spread[c] + to_pooled * pooled
        cov = (1 - to_diagonal) * cov + to_diagonal * np.diag(np.diag(cov)) + 1e-4 * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors[c] = np.linalg.inv(lower)
        terms[c] = np.log(n[c] / n.sum()) - np.log(np.diag(lower)).sum()
    return Discriminant(means, factors, terms, prior)


def train(docs: DataFrame, labels: DataFrame, folds: int, held: int, most_labels: int) -> Discriminant:
    """Learn from the labelled texts of docs; only the class sums come to the driver.

    Of more than most_labels labels those with the least hashes count, so that the side which is broadcast has a bound; only
    labelled texts reach Python, and no text is shuffled.
    """
    rows = labels.where(F.col("quality").isin(0, 1) & ~_fold(folds, held)).select(F.col("doc_id").alias("labelled"), F.col("quality").cast("long").alias("label"))
    rows = rows.orderBy(F.xxhash64("labelled"), "labelled", "label").limit(most_labels)
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    parts = texts.join(F.broadcast(rows), F.col("id") == F.col("labelled")).select("label", "text").mapInArrow(lean(_moments), "label long, sums array<double>")
    sums = np.zeros((2, 1 + len(FEATURES) + len(FEATURES) ** 2))
    for r in parts.select("label", F.posexplode("sums")).groupBy("label", "pos").agg(F.sum("col").alias("s")).collect():
        sums[r["label"], r["pos"]] = r["s"]
    return fit(sums)


def _fold(folds: int, held: int):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == held, F.lit(False))


def classified(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, cut: float = 0.3, most_labels: int = MOST_LABELS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs (doc_id, text).

    Learns from all rows of labels (doc_id, quality) whose crc32(doc_id as text) mod folds isn't `held`, up to most_labels of
    them; rows without a 0 or 1 in quality or without a document don't count. Null texts count as empty, null doc_ids are never
    held out; repeated rows are scored alike. Without labels of both classes every score is 0 or 1, the class that there is
    (1 without any). Extra columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, folds, held, most_labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(model.score(statistics(batch.column(1))))], names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(scored), "doc_id long, score double")
    return out.select("doc_id", _fold(folds, held).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, cut: float = 0.3, most_labels: int = MOST_LABELS) -> DataFrame:
    """The rows of docs, all columns, that classified() predicts 1 for; no row is moved or stored."""
    model, place = train(docs, labels, folds, held, most_labels), docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(statistics(batch.column(place))) >= cut))

    return docs.mapInArrow(lean(keep), docs.schema)
