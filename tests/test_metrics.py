"""Metrics: golden values from published confusion matrices, exact AUC
against MLlib and a brute-force pair count, ties, NULLs, grouping."""

import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from blotter.operators import metrics as M

# Published (TN, FP, FN, TP) and (accuracy, f1, weighted precision, weighted
# recall) to four decimals.
GOLDEN = {
    "LogisticRegression": ((5549, 93, 2030, 133), (0.7280, 0.6376, 0.6923, 0.7280)),
    "RandomForest": ((5641, 1, 1438, 725), (0.8156, 0.7802, 0.8528, 0.8156)),
    "GBT": ((5553, 89, 1082, 1081), (0.8500, 0.8337, 0.8610, 0.8500)),
}


def _expand(spark, model, quartet):
    """Rows of a confusion matrix, generated by Spark from its four counts."""
    tn, fp, fn, tp = quartet
    cells = [(0, 0.0, tn), (0, 1.0, fp), (1, 0.0, fn), (1, 1.0, tp)]
    cell_df = spark.createDataFrame(cells, "label int, prediction double, n long")
    return cell_df.select(
        F.lit(model).alias("model"), "label", "prediction", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i")
    ).filter(F.col("n") > 0)


@pytest.mark.parametrize("model", sorted(GOLDEN))
def test_golden_weighted_metrics(spark, model):
    quartet, expected = GOLDEN[model]
    rows = _expand(spark, model, quartet)
    r = M.weighted_metrics(rows).first()
    got = (r["accuracy"], r["f1"], r["weighted_precision"], r["weighted_recall"])
    assert tuple(round(v, 4) for v in got) == expected
    q = M.outcome_cells(rows).first()
    assert (q["tn"], q["fp"], q["fn"], q["tp"]) == quartet
    w = M.weighted_metrics(rows, with_confusion=True).first()
    assert (w["tn"], w["fp"], w["fn"], w["tp"]) == quartet


def test_weighted_metrics_match_mllib(spark):
    rows = None
    for m, (quartet, _) in GOLDEN.items():
        part = _expand(spark, m, quartet)
        rows = part if rows is None else rows.unionByName(part)
    ours = {r["model"]: r for r in M.weighted_metrics(rows, by=["model"]).collect()}
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    for m in GOLDEN:
        sub = rows.filter(F.col("model") == m).withColumn("label", F.col("label").cast("double"))
        for ours_name, ml_name in [("accuracy", "accuracy"), ("f1", "f1"), ("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")]:
            assert ours[m][ours_name] == pytest.approx(ev.evaluate(sub, {ev.metricName: ml_name}), abs=1e-12)


def _brute_auc(pairs):
    pos = [s for s, l in pairs if l == 1]
    neg = [s for s, l in pairs if l == 0]
    wins = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return wins / (len(pos) * len(neg))


@pytest.fixture()
def ranges(spark):
    """Sets how many score ranges the AUC is summed over."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield lambda n: spark.conf.set(key, str(n))
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("n_ranges", [2, 3, 16, 64])
def test_auc_exact_with_ties(spark, ranges, n_ranges):
    ranges(n_ranges)
    rnd = random.Random(7)
    pairs = [(round(rnd.random(), 2), int(rnd.random() < 0.4)) for _ in range(600)]
    df = spark.createDataFrame(pairs, "score double, label int")
    got = M.auc_roc(df).first()["auc"]
    assert got == pytest.approx(_brute_auc(pairs), abs=1e-12)


def test_auc_matches_mllib_exact_mode(spark):
    rnd = random.Random(3)
    pairs = [(rnd.gauss(0.3 * l, 1.0), float(l)) for l in (int(rnd.random() < 0.3) for _ in range(3000))]
    df = spark.createDataFrame(pairs, "score double, label double")
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert M.auc_roc(df).first()["auc"] == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_auc_hot_score(spark):
    """A score shared by a third of the rows is one aggregated row."""
    rows = [(0.5, i % 2) for i in range(300)] + [(i / 600.0, int(i % 3 == 0)) for i in range(600)]
    df = spark.createDataFrame(rows, "score double, label int")
    assert M.auc_roc(df).first()["auc"] == pytest.approx(_brute_auc(rows), abs=1e-12)


def test_auc_grouped_and_one_class(spark):
    df = spark.createDataFrame(
        [("a", 0.1, 0), ("a", 0.9, 1), ("a", 0.5, 0), ("b", 0.2, 1), ("b", 0.3, 1)],
        "model string, score double, label int",
    )
    got = {r["model"]: r["auc"] for r in M.auc_roc(df, by=["model"]).collect()}
    assert got["a"] == 1.0 and got["b"] is None


def test_nulls_are_not_counted(spark):
    df = spark.createDataFrame(
        [(0, 0.0, 0.1), (1, 1.0, 0.9), (None, 1.0, 0.8), (1, None, None)],
        "label int, prediction double, score double",
    )
    q = M.outcome_cells(df).first()
    assert (q["tn"], q["fp"], q["fn"], q["tp"]) == (1, 0, 0, 1)
    r = M.metrics_record(df).first()
    assert r["accuracy"] == 1.0 and r["auc"] == 1.0


def test_no_countable_rows_give_nulls(spark):
    df = spark.createDataFrame([(None, 1.0, 0.5), (1, None, None)], "label int, prediction double, score double")
    r = M.metrics_record(df, with_confusion=True).first()
    assert r["accuracy"] is None and r["auc"] is None and r["tp"] == 0
    w = M.weighted_metrics(df.filter("label IS NULL")).first()
    assert w is None or w["accuracy"] is None


def test_pivot_and_best(spark):
    rec = spark.createDataFrame(
        [("A", 0.6, 0.7, 0.5, 0.6, 0.7), ("B", 0.8, 0.8, 0.7, 0.9, 0.8), ("C", 0.8, 0.1, 0.1, 0.1, 0.1)],
        "model string, auc double, accuracy double, f1 double, weighted_precision double, weighted_recall double",
    )
    piv = {r["metric"]: r for r in M.metrics_pivot(M.metrics_long(rec), ["A", "B", "C"]).collect()}
    assert set(piv) == set(M.METRIC_NAMES) and piv["auc"]["B"] == 0.8 and piv["f1"]["A"] == 0.5
    assert M.best_by(rec, "auc").first()["model"] == "B"


def _brute_weighted(rows):
    """Class-weighted metrics by definition, over (label, prediction) pairs."""
    labels = sorted({l for l, _ in rows})
    total = len(rows)
    acc = sum(1 for l, p in rows if l == p) / total
    wp = wr = wf = 0.0
    for c in labels:
        tp = sum(1 for l, p in rows if l == c and p == c)
        act = sum(1 for l, _ in rows if l == c)
        prd = sum(1 for _, p in rows if p == c)
        prec = tp / prd if prd else 0.0
        rec = tp / act if act else 0.0
        f1 = 2 * prec * rec / (prec + rec) if prec + rec else 0.0
        wp += act / total * prec
        wr += act / total * rec
        wf += act / total * f1
    return acc, wf, wp, wr


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=2, max_size=60))
def test_property_metrics_match_definitions(spark, pairs):
    """Random labels and tied scores: metrics_record equals the pair count
    and the per-class definitions."""
    rows = [(l, s / 6.0, 1.0 if s >= 3 else 0.0) for l, s in pairs]
    df = spark.createDataFrame(rows, "label int, score double, prediction double")
    rec = M.metrics_record(df, with_confusion=True).first()
    n_pos = sum(1 for l, _, _ in rows if l == 1)
    if 0 < n_pos < len(rows):
        assert rec["auc"] == pytest.approx(_brute_auc([(s, l) for l, s, _ in rows]), abs=1e-12)
    else:
        assert rec["auc"] is None
    acc, f1, wp, wr = _brute_weighted([(float(l), p) for l, _, p in rows])
    assert (rec["accuracy"], rec["f1"], rec["weighted_precision"], rec["weighted_recall"]) == pytest.approx((acc, f1, wp, wr), abs=1e-12)
    assert rec["tn"] + rec["fp"] + rec["fn"] + rec["tp"] == len(rows)


def test_auc_time_does_not_follow_the_number_of_ranges(spark, ranges):
    """400,000 distinct scores: many ranges cost about what few cost."""
    import time

    df = spark.range(400_000).selectExpr("cast(id % 3 = 0 as int) label", "(id * 7919 % 400009) / 400009D score").cache()
    df.count()
    took, value = {}, {}
    for n in (4, 4, 64):
        ranges(n)
        t = time.time()
        value[n] = M.auc_roc(df).first()["auc"]
        took[n] = time.time() - t
    df.unpersist()
    assert value[4] == pytest.approx(value[64], abs=1e-12)
    assert took[64] < 5 * took[4] + 5


def test_grouped_record_over_many_ranges(spark, ranges):
    """Groups that share ranges, groups cut by them, and rows without a score."""
    ranges(7)
    rnd = random.Random(3)
    rows = [(g, int(rnd.random() < 0.3), round(rnd.random(), 2), float(rnd.random() < 0.5)) for g in ("a", "b", "c") for _ in range(300)]
    rows += [("b", 1, None, 1.0), ("b", 0, None, 1.0), ("d", 1, 0.5, 1.0)]
    df = spark.createDataFrame(rows, "model string, label int, score double, prediction double")
    got = {r["model"]: r for r in M.metrics_record(df, by=["model"], with_confusion=True).collect()}
    for g in ("a", "b", "c"):
        own = [r for r in rows if r[0] == g]
        assert got[g]["auc"] == pytest.approx(_brute_auc([(s, l) for _, l, s, _ in own if s is not None]), abs=1e-12)
        assert got[g]["tp"] == sum(1 for _, l, _, p in own if l == 1 and p == 1.0)
        assert got[g]["tn"] + got[g]["fp"] + got[g]["fn"] + got[g]["tp"] == len(own)
    assert got["d"]["auc"] is None and got["d"]["tp"] == 1


def test_other_labels_and_predictions_leave_every_metric(spark):
    rows = [(1, 0.9, 1.0), (0, 0.1, 0.0), (2, 0.5, 1.0), (1, 0.8, 3.0), (None, 0.3, 1.0)]
    df = spark.createDataFrame(rows, "label int, score double, prediction double")
    got = M.metrics_record(df, with_confusion=True).first()
    assert (got["tn"], got["fp"], got["fn"], got["tp"]) == (1, 0, 0, 1)
    assert got["accuracy"] == 1.0 and got["auc"] == 1.0
