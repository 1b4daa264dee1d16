"""Quality rules and the positive-unlabelled classifier."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm.frames import read_table
from blotter.llm.pu_quality import BinnedScorer, estimate_prior, fit_pu, keep_quality, pu_quality
from blotter.llm.quality_rules import FEATURES, IsolationForest, calibrate, calibrated, nth_smallest, quality_rules, rule_statistics, tree_draws
from tests.conftest import SF_MID


def _held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_forest_isolates_outliers_and_path_lengths_are_bounded():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(2000, 3))
    forest = IsolationForest(100, 64, 1).fit(x)
    far = forest.score(np.array([[8.0, 8.0, 8.0]]))[0]
    near = forest.score(x)
    assert far > np.quantile(near, 0.99) and 0 < near.min() and near.max() < 1
    assert IsolationForest.mean_depth(1) == 0 and IsolationForest.mean_depth(2) == 1
    same = IsolationForest(100, 64, 1).fit(x).score(x[:50])
    assert np.array_equal(same, near[:50])


def test_calibration_loses_no_more_good_rows_than_allowed():
    scores = np.linspace(0, 1, 1000)
    good = np.ones(1000, bool)
    good[990:] = False
    cut = calibrate(scores, good, 0.01)
    assert (scores[good] > cut).mean() <= 0.01
    assert calibrate(scores, np.ones(1000, bool), 0.01) == float("inf")


def test_quality_rules_on_labelled_documents(spark):
    labels = read_table(spark, SF_MID, "labels")
    docs = read_table(spark, SF_MID, "documents")
    got = {r["doc_id"]: r for r in quality_rules(docs, labels).collect()}
    assert len(got) == docs.count()
    assert not any(r["base_failed"] and r["kept"] for r in got.values())
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    good = [got[i]["kept"] for i, q in marks.items() if q == 1 and not got[i]["base_failed"]]
    bad = [got[i]["kept"] for i, q in marks.items() if q == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.3


def test_quality_rules_edge_cases(spark, odd_docs, no_docs, no_labels):
    rows = quality_rules(odd_docs, no_labels).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[0]["n_words"] == 0 and by_id[0]["base_failed"] and not by_id[0]["kept"]
    assert by_id[5]["n_words"] == 50_000 and by_id[5]["base_failed"]
    assert quality_rules(no_docs, no_labels).count() == 0


def test_threshold_is_that_of_all_labelled_rows(spark):
    """More labelled rows than any bound: the cut is the exact order statistic."""
    rng = np.random.default_rng(4)
    scores, good = rng.random(30_000).round(4), rng.random(30_000) < 0.8
    table = spark.createDataFrame([(float(x), int(g)) for x, g in zip(scores, good, strict=True)], "anomaly double, mark int")
    for loss in (0.0, 0.01, 0.37, 1.0):
        assert calibrated(table, loss) == calibrate(scores, good, loss)
    assert calibrated(table.where("mark = 1"), 0.01) == calibrated(table.limit(0), 0.01) == float("inf")
    tiny = spark.createDataFrame([(1e-300 * i,) for i in range(5)] + [(0.5,)] * 3, "x double")
    assert [nth_smallest(tiny, n, 4) for n in range(8)] == [*(1e-300 * i for i in range(5)), 0.5, 0.5, 0.5]


def test_every_labelled_row_can_be_drawn(spark):
    """Rows beyond the first 10,000 take part, each tree has its own draw, and
    draws do not depend on the partitions."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.array(*[F.col("id").cast("double")] * len(FEATURES)).alias("features"))
    draws = tree_draws(rows, 150, 64, 3)
    assert [len(np.unique(x[:, 0])) for x in draws] == [64] * 150
    seen = np.unique(np.concatenate([x[:, 0] for x in draws]))
    assert len(seen) > 0.9 * 20_000 * (1 - np.exp(-150 * 64 / 20_000)) and abs(seen.mean() - 10_000) < 500
    again = tree_draws(rows.repartition(5), 150, 64, 3)
    assert all(np.array_equal(a, b) for a, b in zip(draws, again, strict=True))
    assert [len(x) for x in tree_draws(rows.limit(10), 3, 64, 3)] == [10, 10, 10] and tree_draws(rows.limit(0), 3, 64, 3) == []


def test_verdicts_follow_all_labels(spark):
    """Kept documents are those up to the threshold over all labelled rows."""
    docs, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    rows = quality_rules(docs, labels, max_good_loss=0.2).toPandas().set_index("doc_id")
    marks = {r["doc_id"]: r["quality"] for r in labels.where("quality in (0, 1)").collect()}
    known = rows[~rows["base_failed"] & rows.index.isin(marks)]
    cut = calibrate(known["anomaly"].to_numpy(), np.array([marks[i] == 1 for i in known.index]), 0.2)
    assert (rows["kept"] == (~rows["base_failed"] & (rows["anomaly"] <= cut))).all() and np.isfinite(cut)
    assert rule_statistics(docs).count() == len(rows)


def test_prior_is_recovered_from_two_samples():
    rng = np.random.default_rng(3)
    positive = rng.normal(2, 1, 5000)
    unlabelled = np.concatenate([rng.normal(2, 1, 3000), rng.normal(-2, 1, 2000)])
    assert estimate_prior(positive, unlabelled) == pytest.approx(0.6, abs=0.06)


def test_nonnegative_risk_separates_without_negative_labels():
    rng = np.random.default_rng(4)
    positive = rng.normal([1, 0], 0.5, (3000, 2))
    unlabelled = np.concatenate([rng.normal([1, 0], 0.5, (2000, 2)), rng.normal([-1, 0], 0.5, (1000, 2))])
    model, prior = fit_pu(positive, unlabelled)
    p = model.probability(unlabelled)
    assert prior == pytest.approx(2 / 3, abs=0.08)
    good, bad = p[:2000], p[2000:]
    assert ((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean() > 0.97
    assert (good >= 0.7).mean() > 0.95 and (bad < 0.7).mean() > 0.8


def test_bins_give_shared_values_their_own_cell():
    model = BinnedScorer(8)
    x = np.array([[0.0]] * 90 + [[v] for v in np.linspace(0.1, 1, 10)])
    model.edges(x)
    assert len(set(model.cells(x)[:90, 0])) == 1 and model.cells(x)[0, 0] != model.cells(x)[-1, 0]


def test_pu_quality_held_out_accuracy(spark):
    docs, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    got = {r["doc_id"]: r for r in pu_quality(docs, labels).collect()}
    assert all(r["held_out"] == _held_out(i) and r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for i, r in got.items())
    held = [(got[r["doc_id"]]["score"], r["quality"]) for r in labels.collect() if _held_out(r["doc_id"])]
    good = np.array([s for s, q in held if q == 1])
    bad = np.array([s for s, q in held if q == 0])
    auc = ((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean()
    assert auc > 0.95 and (good >= 0.7).mean() > 0.95 and (bad < 0.7).mean() > 0.9


def test_labels_of_the_held_out_fold_are_not_read(spark):
    docs, labels = read_table(spark, SF_MID, "documents"), read_table(spark, SF_MID, "labels")
    flipped = labels.rdd.map(lambda r: (r["doc_id"], 1 - r["quality"] if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 else r["quality"], r["toxic"]))
    flipped = spark.createDataFrame(flipped, labels.schema)
    a = {r["doc_id"]: r["score"] for r in pu_quality(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in pu_quality(docs, flipped).collect()}
    assert a == b


def test_pu_quality_edge_cases(spark, odd_docs, no_docs, no_labels):
    rows = pu_quality(odd_docs, no_labels).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] == 0.5 for r in rows)
    assert pu_quality(no_docs, no_labels).count() == 0
    some = spark.createDataFrame([(4, 1, 0), (None, 1, 0), (5, None, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert pu_quality(odd_docs, some).count() == odd_docs.count()
    assert keep_quality(odd_docs, some).columns == odd_docs.columns
