"""Classifier recipe, fitting and scoring.

The feature part (indexers + assembler) is fitted once on the training rows
over one persisted frame of model rows; every classifier fits on the vectors of
its train rows and scores those of its test rows. Fit time per model is the
wall time of ``fit`` alone, measured on the driver; for the boosted trees it
includes counting the vectors (``counted``).
"""

from __future__ import annotations

import math
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.features import FEATURE_ORDER, FEATURES, category_sizes, fit_features
from blotter.operators.sampling import PART, hash_split, split_salt
from blotter.sources import schema as S

LOGISTIC, FOREST, BOOSTED = "LogisticRegression", "RandomForest", "GBT"
WEIGHT = "n_rows"
#: Rows of a partition of the working set: a tree learner keeps about 500 bytes
#: a row (a bag count per tree), which a task reads at once.
TASK_ROWS = 200_000
#: ``counted`` makes weights of at most 1 / WEIGHT_STEPS of all rows.
WEIGHT_STEPS = 50_000


def make_learner(name: str, features: str = FEATURES, label: str = S.LABEL, seed: int = 42):
    """The three classifiers with their fixed settings."""
    if name == LOGISTIC:
        return LogisticRegression(featuresCol=features, labelCol=label, maxIter=100, regParam=0.01)
    if name == FOREST:
        return RandomForestClassifier(featuresCol=features, labelCol=label, numTrees=100, maxDepth=5, maxBins=64, seed=seed)
    if name == BOOSTED:
        return GBTClassifier(featuresCol=features, labelCol=label, maxIter=50, maxDepth=5, maxBins=64, seed=seed, weightCol=WEIGHT)
    raise ValueError(f"unknown model {name}")


RECIPE = (LOGISTIC, FOREST, BOOSTED)


@dataclass
class FittedSet:
    """Fitted feature model, classifiers and their fit seconds."""

    features: object
    models: dict = field(default_factory=dict)
    train_s: dict = field(default_factory=dict)


MODEL_COLUMNS = (S.INCIDENT_ID, S.LABEL, S.HOUR, S.DISTRICT, S.KIND, S.DOMESTIC_STR)


@dataclass
class WorkingSet:
    """Both parts of a split from one persisted frame of model rows.

    ``rows`` are the rows of each part before indexing, ``kept`` those that
    the indexers keep (rows with an unseen or NULL category are skipped).
    Vectors are made as they are read: learners keep their own copy while
    they fit. ``release`` frees the frame."""

    features: object
    labelled: DataFrame
    rows: dict
    kept: dict

    def part(self, name: str) -> DataFrame:
        part = self.labelled.filter(F.col(PART) == F.lit(name))
        return self.features.transform(part).select(S.INCIDENT_ID, S.LABEL, FEATURES)

    @property
    def train(self) -> DataFrame:
        return self.part("train")

    @property
    def test(self) -> DataFrame:
        return self.part("test")

    def release(self) -> None:
        self.labelled.unpersist()


def prepare(rows: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int | None = None, partitions: int | None = None) -> WorkingSet:
    """Train and test parts of complete model rows, and the feature model.

    The split is decided by each row's values and the seed alone (see
    ``sampling.hash_split``), so it is the same for any partitioning. The
    model columns are dealt to ``partitions`` partitions (default: of about
    ``TASK_ROWS`` rows, and no fewer than the cluster's parallelism) by a hash
    of all their values and persisted once. Indexes
    are fitted on the train part; one pass then counts the rows of both parts
    before and after indexing.
    """
    base = rows.select(*MODEL_COLUMNS)
    base = base.repartition(partitions or max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(base.count() / TASK_ROWS)), *MODEL_COLUMNS)
    labelled = hash_split(base, S.INCIDENT_ID, weights, ("train", "test"), split_salt(seed), MODEL_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    fmodel = fit_features(labelled.filter(F.col(PART) == F.lit("train")))
    indexer = fmodel.stages[0]
    marked = indexer.copy({indexer.handleInvalid: "keep"}).transform(labelled)
    valid = F.lit(True)
    for out, values in zip(indexer.getOutputCols(), indexer.labelsArray, strict=True):
        valid = valid & (F.col(out) < F.lit(len(values)))
    counts = marked.groupBy(PART).agg(F.count(F.lit(1)).alias("n"), F.count_if(valid).alias("k")).collect()
    sizes = {r[PART]: (r["n"], r["k"]) for r in counts}
    names = ("train", "test")
    return WorkingSet(fmodel, labelled, {n: sizes.get(n, (0, 0))[0] for n in names}, {n: sizes.get(n, (0, 0))[1] for n in names})


def check_bins(learner, vectors: DataFrame) -> None:
    """A tree learner bins every category: report the columns that have more
    than its ``maxBins``."""
    if learner.hasParam("maxBins"):
        most = learner.getOrDefault("maxBins")
        over = {c: k for c, k in category_sizes(vectors, learner.getFeaturesCol()).items() if k > most}
        if over:
            raise ValueError(f"{type(learner).__name__}: more categories than maxBins={most}: {over}")


def counted(vectors: DataFrame, features: str = FEATURES, label: str = S.LABEL) -> DataFrame:
    """(features, label, ``WEIGHT``): equal rows once, weighted by their number.
    A learner that sums over all rows and draws none fits the same model on
    them, in passes over the different vectors instead of the rows. Weights
    above 1 / ``WEIGHT_STEPS`` of all rows are dealt over several equal rows, so
    that the learner's sample for candidate splits is as even as one of rows."""
    groups = vectors.groupBy(features, label).agg(F.count(F.lit(1)).alias("__n"))
    most = groups.agg(F.greatest(F.ceil(F.coalesce(F.sum("__n"), F.lit(0)) / WEIGHT_STEPS), F.lit(1)).alias("__most"))
    parts = F.ceil(F.col("__n") / F.col("__most"))
    dealt = groups.crossJoin(F.broadcast(most)).withColumn("__parts", parts).withColumn("__part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    share = F.floor(F.col("__n") / F.col("__parts")) + (F.col("__part") < F.col("__n") % F.col("__parts")).cast("long")
    return dealt.select(features, label, share.cast("double").alias(WEIGHT))


def fit_all(train_vec: DataFrame, names: Sequence[str] = RECIPE, fitted: FittedSet | None = None) -> FittedSet:
    out = fitted or FittedSet(features=None)
    for name in names:
        if name in out.models:
            continue
        learner = make_learner(name)
        check_bins(learner, train_vec)
        t0 = time.time()
        out.models[name] = learner.fit(counted(train_vec) if learner.hasParam("weightCol") and learner.isDefined("weightCol") else train_vec)
        out.train_s[name] = time.time() - t0
    return out


def score(model, vec: DataFrame, name: str) -> DataFrame:
    """(model, incident_id, label, score, prediction) of one classifier.
    The score is the positive-class raw prediction, as MLlib's AUC uses."""
    return model.transform(vec).select(
        F.lit(name).alias("model"),
        S.INCIDENT_ID,
        S.LABEL,
        vector_to_array("rawPrediction")[1].alias("score"),
        F.col("prediction").cast("double").alias("prediction"),
    )


def score_all(fitted: FittedSet, vec: DataFrame, names: Sequence[str]) -> DataFrame:
    out = None
    for n in names:
        s = score(fitted.models[n], vec, n)
        out = s if out is None else out.unionByName(s)
    return out


def importances(forest_model, names: Sequence[str] = FEATURE_ORDER) -> list[tuple[str, float]]:
    """(feature, importance) of a tree ensemble: one value per feature."""
    vals = forest_model.featureImportances.toArray().tolist()
    return list(zip(names, [float(v) for v in vals], strict=True))
