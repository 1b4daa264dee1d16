"""Quality rules: base rules and an isolation forest over rule statistics.

Every text gets its rule statistics (``textstats``). An isolation forest,
grown by random splits on small subsamples, gives each document a mean path
length: few random splits isolate an unusual one. The anomaly score is
``2 ** (-mean path / c(subsample))``; the score above which a document is
rejected is calibrated on labelled rows: the one that rejects most of the
bad rows while it loses at most ``max_good_loss`` of the good ones.

Each tree draws its own ``subsample`` from all labelled rows, as isolation
forests do, by a seeded hash; the threshold is the exact order statistic over the
scores of all labelled rows. Statistics, scores and verdicts cover every document
and its whole text, which is read once: statistics and scores are tables in the
shared folder. The driver holds ``trees * subsample`` rows of the draws.

Edge cases: a null or empty text has no words and fails the base rules; null
ids stay as rows; repeated rows give repeated results; an empty table gives
an empty result; without labelled rows of both kinds only the base rules
decide.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.frames import map_texts, stored
from blotter.llm.textstats import FEATURES, statistics

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Statistics that the forest splits on: those that do not follow the text's
#: length or topic, so that short, long and multilingual texts stay together.
SPLIT_ON = [FEATURES.index(f) for f in ("symbol_share", "upper_share", "distinct_share", "echo_share", "mark_share", "unended_share")]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_FIELDS = [pa.field(c, pa.int64()) for c in COUNTS] + [pa.field("features", pa.list_(pa.float64()))]
_SCHEMA = ", ".join(f"{c} long" for c in COUNTS) + ", features array<double>"


def rule_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, features) of every whole text."""

    def row_of(text: str | None) -> tuple:
        counts, features = statistics(text)
        return (*counts, features)

    return map_texts(docs, row_of, _FIELDS, _SCHEMA)


class IsolationForest:
    """Trees over random feature and cut choices, as flat node arrays."""

    def __init__(self, trees: int = 200, subsample: int = 64, seed: int = 17):
        self.trees, self.subsample, self.seed = trees, subsample, seed

    @staticmethod
    def mean_depth(n: float) -> float:
        """Mean path length of an unsuccessful search in a tree of n rows."""
        return 0.0 if n <= 1 else 2.0 * (np.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0

    def fit(self, x: np.ndarray) -> IsolationForest:
        rng = np.random.default_rng(self.seed)
        size = min(self.subsample, len(x))
        return self.grow((x[rng.permutation(len(x))[:size]] for _ in range(self.trees)), size, rng)

    def grow(self, draws: Iterable[np.ndarray], size: int, rng: np.random.Generator) -> IsolationForest:
        """One tree from each draw of ``size`` rows."""
        self.norm = max(self.mean_depth(size), 1e-9)
        limit = int(np.ceil(np.log2(max(2, size)))) + 4
        self.grown = [self._tree(x, limit, rng) for x in draws]
        return self

    def _tree(self, x: np.ndarray, limit: int, rng: np.random.Generator) -> tuple:
        feature, cut, left, right, depth = [], [], [], [], []
        todo = [(x, 0, None)]
        while todo:
            rows, level, slot = todo.pop()
            me = len(feature)
            if slot is not None:
                slot[0][slot[1]] = me
            low, high = rows.min(0), rows.max(0)
            free = np.flatnonzero(high > low)
            if len(rows) <= 1 or level >= limit or not len(free):
                feature.append(0), cut.append(np.inf), left.append(me), right.append(me)
                depth.append(level + self.mean_depth(len(rows)))
                continue
            f = int(rng.choice(free))
            at = rng.uniform(low[f], high[f])
            below = rows[:, f] <= at
            if below.all():
                below = rows[:, f] < high[f]
            feature.append(f), cut.append(at), left.append(me), right.append(me), depth.append(0.0)
            todo += [(rows[below], level + 1, (left, me)), (rows[~below], level + 1, (right, me))]
        return tuple(np.array(v) for v in (feature, cut, left, right, depth))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores in (0, 1); higher is easier to isolate."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, left, right, depth in self.grown:
            node = np.zeros(len(x), np.int64)
            while True:
                after = np.where(x[rows, feature[node]] <= cut[node], left[node], right[node])
                if (after == node).all():
                    break
                node = after
            total += depth[node]
        return 2.0 ** (-(total / len(self.grown)) / self.norm)


def calibrate(scores: np.ndarray, good: np.ndarray, max_good_loss: float) -> float:
    """The lowest threshold above which at most ``max_good_loss`` of the good
    rows lie; infinite if rows of either kind are missing."""
    if not good.any() or good.all():
        return float("inf")
    ranked = np.sort(scores[good])[::-1]
    return float(ranked[min(int(max_good_loss * len(ranked)), len(ranked) - 1)])


def labels_by_id(labels: DataFrame) -> DataFrame:
    """(doc_id, mark) of the documents labelled good (1) or bad (0)."""
    known = labels.where("doc_id is not null and quality in (0, 1)")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("mark"))


def tree_draws(labelled: DataFrame, trees: int, size: int, seed: int) -> list[np.ndarray]:
    """For each tree the ``size`` labelled rows (doc_id, features) with the
    smallest hashes of its own, of all rows: without replacement, the same for
    any partitioning. Rows whose hash is far above the expected bound are left
    out before the shuffle: of ``4 * size + 64`` rows expected below it, fewer
    than ``size`` are never seen unless rows are equal."""
    n = labelled.count()
    if not n:
        return []
    share = min(1.0, (4 * size + 64) / n)
    bound = int(-(2**63) + share * (2**64 - 1)) if share < 1 else 2**63 - 1
    own = labelled.select("features", F.xxhash64(F.lit(seed), "doc_id", "features").alias("row_hash"))
    every = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.alias("tree"), F.xxhash64("row_hash", t).alias("hash")))
    drawn = own.select("features", F.inline(F.filter(every, lambda d: d["hash"] <= F.lit(bound))))
    ranked = drawn.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy("hash", "features"))).where(F.col("rank") <= size)
    rows = ranked.orderBy("tree", "rank").toPandas()
    return [np.array(group["features"].tolist(), float) for _, group in rows.groupby("tree")]


def nth_smallest(values: DataFrame, n: int, bins: int = 4096) -> float:
    """The value at place ``n`` (from 0) of one column of numbers in order, from
    counts of bins that narrow down on it: at most ``bins`` rows come back."""
    (name,) = values.columns
    x = F.col(name)
    low, high = values.agg(F.min(x), F.max(x)).first()
    while low < high:
        spot = F.least(F.floor((x - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1))
        inside = values.where(x.between(F.lit(low), F.lit(high)))
        for r in sorted(inside.groupBy(spot.alias("bin")).agg(F.count(F.lit(1)).alias("k"), F.min(x).alias("low"), F.max(x).alias("high")).collect()):
            if n < r["k"]:
                low, high = r["low"], r["high"]
                break
            n -= r["k"]
    return float(low)


def calibrated(scored: DataFrame, max_good_loss: float) -> float:
    """``calibrate`` over a table (anomaly, mark) of any size."""
    sizes = {r["mark"]: r["count"] for r in scored.groupBy("mark").count().collect()}
    good = sizes.get(1, 0)
    if not good or not sizes.get(0, 0):
        return float("inf")
    return nth_smallest(scored.where("mark = 1").select("anomaly"), good - 1 - min(int(max_good_loss * good), good - 1))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    trees: int = 200,
    subsample: int = 64,
    max_good_loss: float = 0.01,
    seed: int = 17,
) -> DataFrame:
    """(doc_id, counts, base_failed, anomaly, kept) per document."""
    marks = labels_by_id(labels)
    stats = stored(rule_statistics(docs), "rule-statistics")
    base_failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    draws = tree_draws(stats.join(marks, "doc_id").select("doc_id", "features"), trees, subsample, seed)
    forest, threshold = None, float("inf")
    if draws:
        parts = [x[:, SPLIT_ON] for x in draws]
        forest = IsolationForest(trees, subsample, seed).grow(parts, max(len(x) for x in parts), np.random.default_rng(seed))

    def anomaly(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            rows = np.array(batch.column("features").to_pylist(), float).reshape(-1, len(FEATURES))
            scores = forest.score(rows[:, SPLIT_ON]) if forest is not None else np.zeros(len(rows))
            at = batch.schema.get_field_index("features")
            yield batch.set_column(at, "anomaly", pa.array(scores))

    scored = stored(stats.mapInArrow(anomaly, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS), "anomaly double"])), "rule-scores")
    if forest is not None:
        threshold = calibrated(scored.where(~base_failed).join(marks, "doc_id").select("anomaly", "mark"), max_good_loss)
    return scored.select(
        "doc_id", *COUNTS, base_failed.alias("base_failed"), "anomaly", (~base_failed & (F.col("anomaly") <= threshold)).alias("kept")
    )
