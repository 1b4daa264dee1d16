"""Fitted tree ensembles as tables.

A saved forest or boosted ensemble is a Parquet table of nodes. Read back, it is
a report of every split, and enough to redo what the model does with DataFrame
operations: score rows by one equi-join per level of the trees, and sum the
splits' gains into feature importances. Both give MLlib's own numbers.

The node table has at most ``trees * (2 ** (depth + 1) - 1)`` rows, both fixed
parameters of the learner; up to ``BROADCAST_NODES`` of them are broadcast, as
all rows of a tree start at one node, a hot key for any other join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.features import FEATURE_ORDER
from blotter.operators.metrics import attach
from blotter.session import shared_dir

BROADCAST_NODES = 1 << 18

FOREST_VOTES, BOOSTED_MARGIN = "votes", "margin"


def ensemble_kind(model) -> str:
    """How the trees of a fitted ensemble combine: class shares of the leaves
    add up (forest), or weighted leaf values (boosted)."""
    return FOREST_VOTES if "RandomForest" in type(model).__name__ else BOOSTED_MARGIN


def save_ensemble(spark: SparkSession, model) -> str:
    """Save a fitted ensemble to the shared folder; its path."""
    path = shared_dir(spark, "ensemble")
    model.write().save(path)
    return path


def node_table(spark: SparkSession, path: str, names: Sequence[str] = FEATURE_ORDER, kind: str | None = None) -> DataFrame:
    """One row per node of the ensemble saved at ``path``: tree, node, depth
    unknown; ``left`` and ``right`` children and ``feature`` are null in a leaf.
    ``categories`` lists the values of a categorical split that go left,
    ``threshold`` is the largest value of a continuous one that does; ``stats``
    are class counts (forest) or count, sum and sum of squares (boosted).
    ``n_rows`` are the learner's rows; of a boosted ensemble (``kind``), fitted
    on weighted rows or not, the rows that they stand for."""
    raw = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    inner = F.col("leftChild") >= 0
    values, categorical = F.col("split.leftCategoriesOrThreshold"), F.col("split.numCategories") >= 0
    weights = spark.read.parquet(f"{path}/treesMetadata")
    weights = weights.select(F.col(weights.columns[0]).alias("tree"), F.col(weights.columns[2]).alias("tree_weight"))
    nodes = raw.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("leftChild")).alias("left"),
        F.when(inner, F.col("rightChild")).alias("right"),
        F.when(inner, F.col("split.featureIndex")).alias("feature_index"),
        F.when(inner, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("split.featureIndex") + 1)).alias("feature"),
        F.when(inner & categorical, values).alias("categories"),
        F.when(inner & ~categorical, values[0]).alias("threshold"),
        F.when(inner, F.col("gain")).alias("gain"),
        "impurity",
        F.col("impurityStats").alias("stats"),
        (F.round(F.col("impurityStats")[0]).cast("long") if kind == BOOSTED_MARGIN else F.col("rawCount")).alias("n_rows"),
        "prediction",
    )
    return nodes.join(weights, "tree")


def goes_left(features: str = "features"):
    """Whether a row (array column) goes to the left child of its node."""
    value = F.get(F.col(features), F.col("feature_index"))
    return F.coalesce(F.array_contains("categories", value), value <= F.col("threshold"))


def leaf_of(vectors: DataFrame, nodes: DataFrame, trees: int, depth: int, features: str = "features") -> DataFrame:
    """(features, tree, node): the leaf that each vector reaches in each tree,
    by one join on (tree, node) per level."""
    at = vectors.select(features, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.lit(0).alias("node"))
    splits = nodes.where("left is not null").select("tree", "node", "left", "right", "feature_index", "categories", "threshold")
    if trees * (2 ** (depth + 1) - 1) <= BROADCAST_NODES:
        splits = F.broadcast(splits)
    for _ in range(depth):
        step = F.when(F.col("left").isNull(), F.col("node")).when(goes_left(features), F.col("left")).otherwise(F.col("right"))
        at = at.join(splits, ["tree", "node"], "left").select(features, "tree", step.alias("node"))
    return at


def score_from_nodes(rows: DataFrame, nodes: DataFrame, kind: str, trees: int, depth: int, features: str = "features") -> DataFrame:
    """``rows`` with ``table_score`` and ``table_prediction``: what the ensemble
    of the node table gives them. ``features`` is an array column. Vectors that
    rows share are scored once."""
    at = leaf_of(rows.select(features).distinct(), nodes, trees, depth, features)
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    value = F.col("stats")[1] / total if kind == FOREST_VOTES else F.col("tree_weight") * F.col("prediction")
    other = F.col("stats")[0] / total if kind == FOREST_VOTES else -value
    leaves = nodes.where("left is null").select("tree", "node", value.alias("__one"), other.alias("__zero"))
    if trees * (2 ** (depth + 1) - 1) <= BROADCAST_NODES:
        leaves = F.broadcast(leaves)
    scored = at.join(leaves, ["tree", "node"]).groupBy(features).agg(F.sum("__one").alias("table_score"), F.sum("__zero").alias("__zero"))
    scored = scored.withColumn("table_prediction", (F.col("table_score") > F.col("__zero")).cast("double")).drop("__zero")
    return rows.join(scored, features)


def importances_from_nodes(nodes: DataFrame, kind: str) -> DataFrame:
    """(feature, importance) summed from the splits: gain times the node's
    weight, per tree (a forest gives each tree the same say), then of sum one.
    A feature without a split has no row."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x) if kind == FOREST_VOTES else F.col("stats")[0]
    gains = nodes.where("left is not null").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("gained"))
    if kind == FOREST_VOTES:
        per_tree = gains.groupBy("tree").agg(F.sum("gained").alias("whole")).where("whole > 0")
        gains = gains.join(per_tree, "tree").withColumn("gained", F.col("gained") / F.col("whole"))
    per_feature = gains.groupBy("feature").agg(F.sum("gained").alias("gained"))
    shared = attach(per_feature, per_feature.agg(F.sum("gained").alias("whole")), [])
    return shared.select("feature", F.try_divide("gained", "whole").alias("importance"))


def split_report(nodes: DataFrame, tree: int = 0, node: int = 0) -> DataFrame:
    """One split with its two children: rows, value and impurity of the node,
    the feature and what goes left, the gain, and the children's rows and
    values. No row if the node is a leaf."""
    own = nodes.where((F.col("tree") == tree) & (F.col("node") == node) & F.col("left").isNotNull())
    child = nodes.where(F.col("tree") == tree)
    left = child.select(F.col("node").alias("left"), F.col("n_rows").alias("left_rows"), F.col("prediction").alias("left_prediction"))
    right = child.select(F.col("node").alias("right"), F.col("n_rows").alias("right_rows"), F.col("prediction").alias("right_prediction"))
    return own.join(left, "left").join(right, "right").select(
        "n_rows", "prediction", "impurity", "feature", "threshold", F.array_sort("categories").alias("categories"), "gain",
        "left_rows", "left_prediction", "right_rows", "right_prediction",
    )
