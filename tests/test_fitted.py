"""Node tables and the logistic certificate against MLlib, DuckDB and
hand-written trees."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from blotter.operators import logistic as L
from blotter.operators import metrics as M
from blotter.operators import models as MO
from blotter.operators import trees as T
from blotter.sources import schema as S

NAMES = ("a", "b", "c")


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(1500, 3)), 2)
    y = (rng.random(1500) < 1 / (1 + np.exp(-(x[:, 0] - 0.5 * x[:, 1] ** 2)))).astype(int)
    rows = spark.createDataFrame([(i, *map(float, v), int(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))], "id long, a double, b double, c double, label int")
    return VectorAssembler(inputCols=list(NAMES), outputCol="features").transform(rows).select("id", "label", "features").cache()


@pytest.mark.parametrize(
    "make,settings",
    [
        (RandomForestClassifier, {"numTrees": 7, "maxDepth": 4, "seed": 3}),
        (GBTClassifier, {"maxIter": 6, "maxDepth": 3, "stepSize": 0.2, "seed": 3}),
        (RandomForestClassifier, {"numTrees": 2, "maxDepth": 0}),
    ],
)
def test_table_scores_and_importances_equal_the_model(spark, train, make, settings):
    learner = make(**settings)
    model = learner.fit(train)
    kind, depth = T.ensemble_kind(model), learner.getMaxDepth()
    nodes = T.node_table(spark, T.save_ensemble(spark, model), NAMES)
    assert nodes.count() == model.totalNumNodes
    made = model.transform(train).select("id", vector_to_array("features").alias("features"), vector_to_array("rawPrediction")[1].alias("score"), "prediction")
    got = T.score_from_nodes(made, nodes, kind, model.getNumTrees, depth)
    assert got.count() == 1500
    assert got.where("prediction <> table_prediction or abs(score - table_score) > 1e-12").count() == 0
    own = dict(zip(NAMES, model.featureImportances.toArray(), strict=True))
    found = {r.feature: r.importance for r in T.importances_from_nodes(nodes, kind).collect()}
    assert found == pytest.approx({k: v for k, v in own.items() if v > 0}, abs=1e-12)


def test_hand_made_tree(spark):
    schema = "tree int, node int, left int, right int, feature_index int, feature string, categories array<double>, threshold double, gain double, impurity double, stats array<double>, n_rows long, prediction double, tree_weight double"
    rows = [
        (0, 0, 1, 4, 1, "b", [0.0, 2.0], None, 0.5, 0.5, [4.0, 4.0], 8, 0.0, 1.0),
        (0, 1, 2, 3, 0, "a", None, 1.5, 0.25, 0.4, [3.0, 1.0], 4, 0.0, 1.0),
        (0, 2, None, None, None, None, None, None, None, 0.0, [3.0, 0.0], 3, 0.0, 1.0),
        (0, 3, None, None, None, None, None, None, None, 0.0, [0.0, 1.0], 1, 1.0, 1.0),
        (0, 4, None, None, None, None, None, None, None, 0.4, [1.0, 3.0], 4, 1.0, 1.0),
        (1, 0, None, None, None, None, None, None, None, 0.5, [1.0, 1.0], 2, 0.0, 1.0),
    ]
    nodes = spark.createDataFrame(rows, schema)
    vectors = spark.createDataFrame([(1, [1.5, 0.0]), (2, [1.6, 2.0]), (3, [0.0, 1.0]), (4, [1.5, 0.0])], "id long, features array<double>")
    got = {r.id: (r.table_score, r.table_prediction) for r in T.score_from_nodes(vectors, nodes, T.FOREST_VOTES, 2, 2).collect()}
    assert got == {1: (0.5, 0.0), 2: (1.5, 1.0), 3: (1.25, 1.0), 4: (0.5, 0.0)}
    # gains 0.5 * 8 and 0.25 * 4 in the only tree with splits
    assert {r.feature: r.importance for r in T.importances_from_nodes(nodes, T.FOREST_VOTES).collect()} == {"b": 0.8, "a": 0.2}
    split = T.split_report(nodes).first()
    assert (split.feature, split.categories, split.left_rows, split.right_prediction) == ("b", [0.0, 2.0], 4, 1.0)
    assert T.split_report(nodes, tree=1).collect() == []


def test_optimum_is_what_the_fit_reaches(spark, train):
    model = LogisticRegression(maxIter=100, regParam=0.05).fit(train)
    rows = train.select("label", vector_to_array("features").alias("features"))
    fit = [*model.coefficients.toArray(), model.intercept]
    best = L.optimum(rows, fit, 0.05)
    assert best.rows == 1500 and best.gradient < 1e-12
    assert np.abs(best.coefficients - fit).max() < 1e-5
    # from nothing it is the same point; a constant model is far from it
    again = L.optimum(rows, [0.0] * 4, 0.05)
    assert np.abs(best.coefficients - again.coefficients).max() < 1e-10
    assert again.gradient_at_start > 0.05 > 1e-4 > best.gradient_at_start


def test_optimum_with_a_constant_feature_and_few_rows(spark):
    rows = spark.createDataFrame([(0, [1.0, 5.0]), (1, [2.0, 5.0]), (1, [1.0, 5.0]), (0, [2.0, 5.0]), (1, [3.0, 5.0])], "label int, features array<double>")
    best = L.optimum(rows, [0.0, 0.0, 0.0], 0.1)
    assert best.coefficients[1] == 0.0 and best.gradient < 1e-12
    with pytest.raises(ValueError):
        L.optimum(rows.limit(1), [0.0, 0.0, 0.0], 0.1)


def test_stored_scores_give_the_metrics_in_another_engine(spark, train, tmp_path):
    model = RandomForestClassifier(numTrees=5, maxDepth=3, seed=1).fit(train)
    scored = model.transform(train).select(F.lit("m").alias("model"), "label", vector_to_array("rawPrediction")[1].alias("score"), "prediction")
    path = str(tmp_path / "scores")
    scored.write.parquet(path)
    sql = f"""
      WITH t AS (SELECT * FROM read_parquet('{path}/*.parquet')),
      pairs AS (SELECT avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) AS auc
                FROM t p JOIN t n ON p.label = 1 AND n.label = 0)
      SELECT auc, (SELECT avg((label = prediction)::INT) FROM t), (SELECT count(*) FROM t WHERE label = 1 AND prediction = 1) FROM pairs"""
    auc, accuracy, tp = duckdb.connect().execute(sql).fetchone()
    got = M.metrics_record(spark.read.parquet(path), by=["model"], with_confusion=True).first()
    assert (got["auc"], got["accuracy"], got["tp"]) == (pytest.approx(auc, abs=1e-12), pytest.approx(accuracy, abs=1e-12), tp)


@pytest.mark.parametrize("steps", [MO.WEIGHT_STEPS, 300])
def test_counted_vectors_fit_the_trees_of_the_rows(spark, train, monkeypatch, steps):
    """The boosted trees of weighted vectors are those of the rows, whose number
    the node table gives; five copies of the rows are no more work."""
    monkeypatch.setattr(MO, "WEIGHT_STEPS", steps)
    rows = train
    for _ in range(4):
        rows = rows.unionByName(train)
    once, many = MO.counted(train), MO.counted(rows)
    n = train.count()
    assert once.agg(F.sum(MO.WEIGHT)).first()[0] == n and many.agg(F.sum(MO.WEIGHT)).first()[0] == 5 * n
    vectors = train.select(MO.FEATURES, S.LABEL).distinct().count()
    assert many.count() <= vectors + steps and many.agg(F.max(MO.WEIGHT)).first()[0] <= math.ceil(5 * n / steps)
    learner = MO.make_learner(MO.BOOSTED).setMaxIter(3)
    plain = GBTClassifier(featuresCol=MO.FEATURES, labelCol=S.LABEL, maxIter=3, maxDepth=5, maxBins=64, seed=42)
    own = learner.fit(many)
    table = T.node_table(spark, T.save_ensemble(spark, own), kind=T.BOOSTED_MARGIN)
    other = T.node_table(spark, T.save_ensemble(spark, plain.fit(rows)), kind=T.BOOSTED_MARGIN)
    got, want = ([tuple(r) for r in t.select("tree", "node", "feature", "threshold", "categories", "n_rows", F.round("prediction", 6)).orderBy("tree", "node").collect()] for t in (table, other))
    assert got == want and got[0][5] == 5 * n
    assert own.getNumTrees == 3
