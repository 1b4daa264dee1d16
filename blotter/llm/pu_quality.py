"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; the unlabelled side is all web
text outside the held-out fold, whose labels are never read. The model is additive
over quantile bins of the rule statistics (one weight per bin) and minimises the
non-negative unbiased risk

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

with the squared loss (1 - y z)^2 / 4; as soon as the bracket turns negative, only
its sign-flipped gradient is followed. Under this loss a side's risk is a quadratic
form of how often each pair of bins meets in a text, so one aggregate of pair
counts holds all that the risk needs of the unlabelled side, at any corpus size.
Bin edges come from counts of the statistics' levels (floats cut to 9 bits of
mantissa), and the class prior from a histogram of scores: the smallest ratio,
over thresholds, of the unlabelled to the positive mass above one, with a slack
for sampling error. A second histogram, of the fitted z, gives slope and offset of
the logistic curve from z to the score, by the same risk with the logistic loss.
All are integer sums over all unlabelled texts, so reruns agree; the statistics
are computed once and stored.

Labels come only from rows outside the held-out fold (crc32 of the id's text
modulo 4 is 2). The fit uses at most ``max_positive`` labelled positives, a
documented bound, chosen by a seeded hash of the id; every document is scored over
its whole text.

Edge cases: null and empty texts get statistics of an empty text and a score;
a null id counts as not held out; of a positive id with several texts one is
learnt from; repeated rows give repeated results; an empty table gives an empty
result; with no positive to learn from every score is the prior 0.5.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.frames import doc_texts, id_sample, stored, text_fold
from blotter.llm.textstats import FEATURES, statistics

HELD_OUT_MODULUS, HELD_OUT_FOLD = 4, 2
ACCEPT = 0.7
#: Thresholds of score histograms.
GRID = np.linspace(-4, 4, 4001)
#: Bits of a float32 that a level leaves out.
LEVEL_SHIFT = 14


def levels(text: str | None) -> np.ndarray:
    """The text's statistics (none is negative) as integers of the same order."""
    return np.array(statistics(text)[1], np.float32).view(np.int32) >> LEVEL_SHIFT


class BinnedScorer:
    """Additive model over quantile bins of each feature."""

    def __init__(self, bins: int = 16):
        self.bins = bins

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Column numbers of the bins that each row falls in."""
        return np.stack([j * self.bins + np.searchsorted(c, x[:, j], "right") for j, c in enumerate(self.cuts)], 1)

    def edges(self, x: np.ndarray) -> None:
        self.edges_of([np.unique(x[:, j], return_counts=True) for j in range(x.shape[1])])

    def edges_of(self, counted: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Inner cuts at quantiles of each feature's (values, counts); a value
        that fills two quantiles or more gets a bin of its own."""
        self.cuts = []
        for values, counts in counted:
            upto = np.cumsum(counts)
            spots = np.linspace(0, upto[-1] - 1, self.bins - 1).astype(np.int64)
            q, times = np.unique(values[np.searchsorted(upto, spots, "right")].astype(float), return_counts=True)
            self.cuts.append(np.union1d(q, np.nextafter(q[times > 1], np.inf)))
        self.clear()

    def clear(self) -> None:
        self.w, self.b = np.zeros(self.bins * len(self.cuts)), 0.0
        self.slope, self.offset = 1.0, 0.0

    def raw(self, cells: np.ndarray) -> np.ndarray:
        return self.w[cells].sum(1) + self.b

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(self.cells(x)) + self.offset) if len(x) else np.zeros(0)

    def pair_counts(self, x: np.ndarray) -> np.ndarray:
        """How often each pair of columns (the last one is 1) meets in a row."""
        size = len(self.w) + 1
        total = np.zeros(size * size, np.int64)
        for at in range(0, len(x), 8192):
            cells = self.cells(x[at : at + 8192])
            cells = np.concatenate([cells, np.full((len(cells), 1), size - 1)], 1)
            total += np.bincount((cells[:, :, None] * size + cells[:, None, :]).ravel(), minlength=size * size)
        return total.reshape(size, size)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def descend(v: np.ndarray, gradient: Callable[[np.ndarray], np.ndarray], steps: int, rate: float, decay: float) -> np.ndarray:
    """Adam from ``v``, whose last entry is an offset and doesn't decay."""
    m = s = 0.0
    for t in range(1, steps + 1):
        g = gradient(v) + decay * np.append(v[:-1], 0)
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        v = v - rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return v


def histogram(scores: np.ndarray) -> np.ndarray:
    """Scores between neighbouring thresholds of ``GRID``, below and above."""
    return np.bincount(np.searchsorted(GRID, scores, "right"), minlength=len(GRID) + 1)


def prior_of(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled, from histograms: the smallest
    ratio of the two upper tails, each widened by its sampling error."""
    slack = lambda counts: np.sqrt(np.log(200) / (2 * counts.sum()))
    p, u = (1 - np.cumsum(x)[:-1] / x.sum() for x in (positive, unlabelled))
    some = (p > 4 * slack(positive)) & (p > 0.02) & (p < 0.98)
    ratios = (u[some] + slack(unlabelled)) / (p[some] - slack(positive))
    return float(np.clip(ratios.min(initial=1.0), 0.05, 0.99))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    return prior_of(histogram(positive), histogram(unlabelled))


def calibrate(model: BinnedScorer, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 2000, rate: float = 0.05, decay: float = 1e-3) -> None:
    """Slope and offset of the curve from z to the score, from histograms of z."""
    z = np.concatenate([GRID[:1], (GRID[1:] + GRID[:-1]) / 2, GRID[-1:]])
    fp, fu = positive / positive.sum(), unlabelled / unlabelled.sum()

    def gradient(v: np.ndarray) -> np.ndarray:
        t = v[0] * z + v[1]
        s, lose = _sigmoid(t), np.logaddexp(0, t)
        pull = lambda f: np.array([f @ z, f.sum()])
        bracket = pull(fu * s) - prior * pull(fp * s)
        if fu @ lose < prior * (fp @ lose):
            return -bracket
        return prior * pull(fp * (s - 1)) + bracket

    model.slope, model.offset = (float(x) for x in descend(np.array([2.0, 0.0]), gradient, steps, rate, decay))


def fit_risk(model: BinnedScorer, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, rate: float = 0.02) -> None:
    """Minimise the non-negative unbiased risk from the two sides' pair counts;
    the ridge is one over the number of positives."""
    mp, mu = positive / positive[-1, -1], unlabelled / unlabelled[-1, -1]

    def risk(m: np.ndarray, v: np.ndarray, y: int) -> float:
        return (1 - 2 * y * (m[-1] @ v) + v @ m @ v) / 4

    def pull(m: np.ndarray, v: np.ndarray, y: int) -> np.ndarray:
        return (m @ v - y * m[-1]) / 2

    def gradient(v: np.ndarray) -> np.ndarray:
        bracket = pull(mu, v, -1) - prior * pull(mp, v, -1)
        if risk(mu, v, -1) < prior * risk(mp, v, -1):  # step back out of overfitting
            return -bracket
        return prior * pull(mp, v, 1) + bracket

    v = descend(np.zeros(len(mp)), gradient, steps, rate, 1 / positive[-1, -1])
    model.w, model.b = v[:-1], float(v[-1])


def fit_against(model: BinnedScorer, positive: np.ndarray, unlabelled: np.ndarray, steps: int = 400, rate: float = 0.02) -> None:
    """Positives against all unlabelled: the scorer whose histograms give the prior."""
    mp, mu = positive / positive[-1, -1], unlabelled / unlabelled[-1, -1]
    v = descend(np.zeros(len(mp)), lambda v: ((mp + mu) @ v + mu[-1] - mp[-1]) / 2, steps, rate, 1 / positive[-1, -1])
    model.w, model.b = v[:-1], float(v[-1])


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[BinnedScorer, float]:
    """(model, class prior) of two samples at hand."""
    model = BinnedScorer()
    model.edges(unlabelled)
    pp, pu = model.pair_counts(positive), model.pair_counts(unlabelled)
    z = lambda x: histogram(model.raw(model.cells(x)))
    fit_against(model, pp, pu)
    prior = prior_of(z(positive), z(unlabelled))
    fit_risk(model, pp, pu, prior)
    calibrate(model, z(positive), z(unlabelled), prior)
    return model, prior


def _held_out() -> Column:
    return text_fold("doc_id", HELD_OUT_MODULUS) == HELD_OUT_FOLD


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, len(FEATURES))


def _level_counts(rows: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per feature (levels, counts) over all rows. There are at most 2**18
    levels a feature, so that bounds what reaches the driver."""
    counted = rows.select(F.posexplode("levels").alias("j", "level")).groupBy("j", "level").count().orderBy("j", "level").toPandas()
    return [(g["level"].to_numpy(), g["count"].to_numpy()) for _, g in counted.groupby("j")]


def _pair_counts(rows: DataFrame, model: BinnedScorer) -> np.ndarray:
    """``model.pair_counts`` over all rows: a matrix per task, summed cell by
    cell. The driver gets one number a cell."""
    size = len(model.w) + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            total += model.pair_counts(_matrix(batch.column(0)))
        at = np.flatnonzero(np.triu(total))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total.ravel()[at])], names=["cell", "n"])

    summed = rows.select("levels").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size * size, np.int64)
    out[summed["cell"]] = summed["n"]
    upper = out.reshape(size, size)
    return upper + np.triu(upper, 1).T


def _histogram(rows: DataFrame, model: BinnedScorer) -> np.ndarray:
    """``histogram`` of z over all rows: the driver gets one number a cell."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total = np.zeros(len(GRID) + 1, np.int64)
        for batch in batches:
            total += histogram(model.raw(model.cells(_matrix(batch.column(0)))))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["cell", "n"])

    summed = rows.select("levels").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(len(GRID) + 1, np.int64)
    out[summed["cell"]] = summed["n"]
    return out


def quality_score(docs: DataFrame, labels: DataFrame, max_positive: int = 10_000, seed: int = 23):
    """Fit the classifier; returns a column function from text to score."""
    held_out = _held_out()

    def text_levels(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            made = [levels(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.int32()))], names=["doc_id", "levels"])

    unlabelled = stored(doc_texts(docs).where(~held_out).mapInArrow(text_levels, "doc_id long, levels array<int>"), "quality-levels")
    trusted = labels.where("doc_id is not null").where(~held_out).groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1")
    # at most max_positive ids
    learnt = unlabelled.join(F.broadcast(id_sample(trusted, max_positive, seed)), "doc_id").groupBy("doc_id").agg(F.min("levels").alias("levels"))
    positive = np.array(learnt.orderBy("doc_id").toPandas()["levels"].tolist(), np.int64).reshape(-1, len(FEATURES))
    model = None
    if len(positive):
        model = BinnedScorer()
        model.edges_of(_level_counts(unlabelled))
        pp, pu = model.pair_counts(positive), _pair_counts(unlabelled, model)
        fit_against(model, pp, pu)
        z = lambda: histogram(model.raw(model.cells(positive)))
        prior = prior_of(z(), _histogram(unlabelled, model))
        fit_risk(model, pp, pu, prior)
        calibrate(model, z(), _histogram(unlabelled, model), prior)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        if model is None:
            return pd.Series(np.full(len(text), 0.5))
        rows = np.array([levels(t) for t in text], np.int64).reshape(-1, len(FEATURES))
        return pd.Series(model.probability(rows))

    return score


def pu_quality(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """(doc_id, held_out, score, predicted) per document."""
    score = quality_score(docs, labels, **options)
    scored = doc_texts(docs).select("doc_id", _held_out().alias("held_out"), score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= ACCEPT).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """``docs``, all columns, without the documents that the classifier
    rejects. Scores and filters each row where it lies: no shuffle."""
    return docs.where(quality_score(docs, labels, **options)(F.col("text")) >= ACCEPT)
