"""Quality scores by a regularised quadratic discriminant over transformed document statistics.

One pass over the whole texts counts, for each document, pairs of (hits, trials): capitals among
letters, symbols among characters, words without letters, adjacent equal words, repeated lines and so
on. The counts are written once; everything after reads those few numbers. A statistic is the log odds
of hits, smoothed towards the rate of all training rows, so a short text stays near the middle instead
of at an extreme. Each class gets a mean and a covariance shrunk towards the pooled covariance and
towards its diagonal; both Cholesky factors are computed once on the driver and reused for every row.
The score is the logistic of the difference of the two log densities (Mahalanobis terms and log
determinants) plus the difference of the log priors.

All labelled rows outside the held-out remainder take part in the fit; sums by class and by pair of
statistics are aggregated in Spark, so the driver gets a table whose size depends on the number of
statistics alone. How strongly counts are smoothed is chosen among those rows: they form a fold for each
of the other remainders, every fold is scored by models of the other folds, and the smoothing with the
fewest errors at the threshold (then the least log loss), each class weighing the same, is kept.

Defined cases: null and empty texts have no trials and get the score of the smoothed rates; null or
other labels than 0 and 1 are ignored, repeated labels count as often as they stand; with no row of
one class every score is the share of class 1 (0.5 without labels); repeated rows each get a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable

#: (hits, trials) of each statistic; the names are columns of ``counts``.
STATISTICS = (
    ("capitals", "letters"),
    ("symbols", "visible"),
    ("exclaims", "visible"),
    ("stops", "visible"),
    ("digits", "visible"),
    ("bare_words", "words"),
    ("short_words", "words"),
    ("long_words", "words"),
    ("odd_ends", "words"),
    ("equal_neighbours", "words"),
    ("repeated_lines", "lines"),
)
COUNTS = ("letters", "visible", "words", "lines", *(h for h, _ in STATISTICS))
DIM = len(STATISTICS) + 1

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, np.int64)
_LETTER[[*range(65, 91), *range(97, 123), *range(192, 256)]] = 1  # a lead byte stands for its character
_CHARACTER = np.ones(256, np.int64)
_CHARACTER[128:192] = 0
_ODD_END = np.zeros(256, bool)
_ODD_END[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:?!'\")"]] = True
_SYMBOLS = [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:?!'\"()-"]


def counts(text: str | None) -> np.ndarray:
    """The counts of one whole text, in the order of ``COUNTS``."""
    out = np.zeros(len(COUNTS))
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return out
    each = np.bincount(data, minlength=256)
    letters = np.add.reduceat(_LETTER[data], starts)
    length = np.add.reduceat(_CHARACTER[data] * ~space, starts)
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    visible = int(each @ _CHARACTER) - int(space.sum())
    out[:] = (
        letters.sum(), visible, len(starts), len(lines),
        each[65:91].sum(), each[_SYMBOLS].sum(), each[33] + each[63], each[46] + each[44], each[48:58].sum(),
        (letters == 0).sum(), (letters <= 3).sum(), (length >= 8).sum(), _ODD_END[data[ends - 1]].sum(),
        sum(map(eq, words, words[1:])), len(lines) - len(set(lines)),
    )
    return out


def document_counts(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, counts``; one row per input row."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _of_texts(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), _as_lists(found)], ["doc_id", "counts"])

    return rows.mapInArrow(run, f"doc_id {kind}, counts array<double>")


def _of_texts(texts: pa.Array) -> np.ndarray:
    return np.array([counts(t.as_py()) for t in texts]).reshape(len(texts), len(COUNTS))


def _as_lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def transform(found: np.ndarray, rates: np.ndarray, smoothing: float) -> np.ndarray:
    """Smoothed log odds of each statistic, and the log of characters per word."""
    column = {name: found[:, i] for i, name in enumerate(COUNTS)}
    out = np.empty((len(found), DIM))
    for i, (hits, trials) in enumerate(STATISTICS):
        h = column[hits] + smoothing * rates[i]
        out[:, i] = np.log(h) - np.log(np.maximum(column[trials] - column[hits], 0) + smoothing * (1 - rates[i]))
    out[:, -1] = np.log(column["visible"] + smoothing * rates[-1]) - np.log(column["words"] + smoothing)
    return out


@dataclass(frozen=True)
class QualityModel:
    rates: np.ndarray
    smoothing: float
    log_prior: np.ndarray
    means: np.ndarray | None
    factors: tuple[np.ndarray, np.ndarray] | None
    whiteners: tuple[np.ndarray, np.ndarray] | None = None  # inverses of the factors, once for all rows

    def score(self, found: np.ndarray) -> np.ndarray:
        if self.factors is None:
            return np.full(len(found), self.log_prior[1])
        x = transform(found, self.rates, self.smoothing)
        density = []
        for mean, factor, whiten, prior in zip(self.means, self.factors, self.whiteners, self.log_prior):
            z = whiten @ (x - mean).T
            density.append(prior - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


#: Trials that counts may be smoothed by; one of them is chosen in the learning rows.
SMOOTHINGS = (10.0, 20.0, 40.0, 80.0, 160.0)


def _model(total: np.ndarray, rates: np.ndarray, smoothing: float, pooled: float, diagonal: float) -> QualityModel:
    """From the sums by class of products of the statistics and one."""
    n = total[:, 0, 0]
    if n.min() < 2:
        share = n[1] / n.sum() if n.sum() else 0.5
        return QualityModel(rates, smoothing, np.array([1 - share, share]), None, None)
    means = total[:, 0, 1:] / n[:, None]
    own = np.array([total[c, 1:, 1:] / n[c] - np.outer(means[c], means[c]) for c in (0, 1)])
    shared = np.tensordot(n / n.sum(), own, 1)
    factors = []
    for c in (0, 1):
        s = (1 - pooled) * own[c] + pooled * shared
        s = (1 - diagonal) * s + diagonal * np.diag(np.diag(s)) + 1e-4 * np.eye(DIM)
        factors.append(np.linalg.cholesky(s))
    return QualityModel(rates, smoothing, np.log(n / n.sum()), means, tuple(factors), tuple(map(np.linalg.inv, factors)))


def _rates(sums: np.ndarray) -> np.ndarray:
    """Hits over trials of every statistic, and characters over words, from sums in the order of ``COUNTS``."""
    of = dict(zip(COUNTS, sums))
    return np.array([*((of[h] + 0.5) / (of[t] + 1) for h, t in STATISTICS), of["visible"] / max(of["words"], 1) or 1.0])


def _moments(rows: DataFrame, plans: list[tuple[float, np.ndarray]], folds: int) -> np.ndarray:
    """Sums by plan (smoothing, rates), fold and class of products of the transformed statistics and one."""
    shape = (len(plans), folds, 2, DIM + 1, DIM + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            y, fold = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = batch.column(2).flatten().to_numpy().reshape(-1, len(COUNTS))
            for i, (smoothing, rates) in enumerate(plans):
                x = np.hstack([np.ones((len(y), 1)), transform(found, rates, smoothing)])
                for f in range(folds):
                    for c in (0, 1):
                        mine = x[(y == c) & (fold == f)]
                        total[i, f, c] += mine.T @ mine
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["i", "s"])

    out = np.zeros(shape)
    for r in rows.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():  # as many as ``shape`` says
        out.flat[r["i"]] = r["s"]
    return out


def _chosen_smoothing(rows: DataFrame, sums: np.ndarray, smoothings: tuple[float, ...], threshold: float, shrink: tuple[float, float]) -> float:
    """The smoothing whose models of all other folds do best on each fold."""
    folds = len(sums)
    rates = [_rates(sums.sum(axis=0) - sums[f]) for f in range(folds)]
    plans = [(s, rates[f]) for s in smoothings for f in range(folds)]
    total = _moments(rows, plans, folds)
    models = []
    for i, (s, r) in enumerate(plans):
        others = [g for g in range(folds) if g != i % folds]
        models.append(_model(total[i, others].sum(axis=0), r, s, *shrink))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(models), 2, 3))
        for batch in batches:
            y, fold = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            found = batch.column(2).flatten().to_numpy().reshape(-1, len(COUNTS))
            for i, model in enumerate(models):
                for c in (0, 1):
                    mine = (y == c) & (fold == i % folds)
                    p = model.score(found[mine])
                    right = np.clip(p if c else 1 - p, 1e-12, 1)
                    out[i, c] += mine.sum(), ((p >= threshold) != bool(c)).sum(), -np.log(right).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(out.size)), pa.array(out.ravel())], ["i", "s"])

    seen = np.zeros((len(smoothings), folds, 2, 3))
    for r in rows.mapInArrow(run, "i long, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
        seen.flat[r["i"]] = r["s"]
    by = seen.sum(axis=1)
    loss = by[:, :, 1:] / np.maximum(by[:, :, :1], 1)
    return min(zip(loss[:, :, 0].sum(axis=1).round(9), loss[:, :, 1].sum(axis=1), smoothings))[2]


def fit(
    stats: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    label: str = "quality",
    modulus: int = 4,
    held_out: int = 2,
    smoothing: float | tuple[float, ...] = SMOOTHINGS,
    threshold: float = 0.7,
    pooled: float = 0.1,
    diagonal: float = 0.05,
) -> QualityModel:
    """Fit on the labelled rows of ``stats`` whose crc32 of the id is not in the held-out remainder."""
    learn = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("y")).where("y in (0, 1)")
    learn = learn.withColumn("fold", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus).cast("int")).where(F.col("fold") != held_out)
    learn = learn.withColumn("fold", F.col("fold") - (F.col("fold") > held_out).cast("int"))
    rows = durable(stats.join(learn, "doc_id").select("y", "fold", "counts"))
    sums = np.zeros((max(modulus - 1, 1), len(COUNTS)))
    for r in rows.groupBy("fold").agg(*[F.sum(F.col("counts")[i]).alias(n) for i, n in enumerate(COUNTS)]).collect():  # a row a fold
        sums[r["fold"]] = [r[n] for n in COUNTS]
    rates = _rates(sums.sum(axis=0))
    if isinstance(smoothing, tuple):
        smoothing = _chosen_smoothing(rows, sums, smoothing, threshold, (pooled, diagonal))
    total = _moments(rows, [(smoothing, rates)], len(sums))[0].sum(axis=0)
    return _model(total, rates, smoothing, pooled, diagonal)


def score(stats: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``stats``."""
    kind = stats.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = model.score(batch.column(1).flatten().to_numpy().reshape(-1, len(COUNTS)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return stats.select("doc_id", "counts").mapInArrow(run, f"doc_id {kind}, score double, predicted int")


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """Fit on the labelled documents and score all of them."""
    stats = durable(document_counts(docs))
    return score(stats, fit(stats, labels, threshold=threshold, **options), threshold)


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents whose score reaches the threshold, with all their columns; rows are not shuffled."""
    stats = durable(document_counts(docs, key=key, text=text))
    model = fit(stats, labels, threshold=threshold, **options)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.score(_of_texts(batch.column(at))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
