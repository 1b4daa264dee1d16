"""Sampling invariants, indexer skip behaviour, model fits and reports."""

import math
import os

import pytest
from pyspark.sql import functions as F

from blotter.functions.columns import text_bar
from blotter.operators import features as FE
from blotter.operators import models as MO
from blotter.operators import report as R
from blotter.operators import sampling as SM
from blotter.plans.catalog import incidents_at, model_rows
from blotter.sources import schema as S
from tests.conftest import SF_MID, SF_SMALL


def test_bernoulli_sample_is_subset_and_sized(spark):
    inc = incidents_at(spark, SF_MID)
    n = inc.count()
    s = SM.bernoulli_sample(inc, 0.05, 42)
    k = s.count()
    sigma = math.sqrt(n * 0.05 * 0.95)
    assert abs(k - 0.05 * n) < 5 * sigma
    assert s.join(inc, S.INCIDENT_ID, "left_anti").count() == 0


def test_random_split_partitions_input(spark):
    inc = incidents_at(spark, SF_MID)
    lab = SM.labelled_random_split(inc, (0.8, 0.2), seed=42).cache()
    assert lab.count() == inc.count()
    assert lab.select(S.INCIDENT_ID).distinct().count() == inc.count()
    lab.unpersist()


def test_hash_sample_independent_of_partitioning(spark):
    inc = incidents_at(spark, SF_MID)
    a = SM.hash_sample(inc, S.INCIDENT_ID, 0.05).select(S.INCIDENT_ID)
    b = SM.hash_sample(inc.repartition(7), S.INCIDENT_ID, 0.05).select(S.INCIDENT_ID)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hash_split_three_way(spark):
    inc = incidents_at(spark, SF_MID)
    sizes = {r["part"]: r["n_rows"] for r in SM.part_sizes(SM.hash_split(inc, S.INCIDENT_ID, (1, 1, 2), ("a", "b", "c"))).collect()}
    assert sum(sizes.values()) == inc.count()
    assert abs(sizes["c"] / 10000 - 0.5) < 0.03


def test_indexer_skips_unseen_and_null(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    test = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    model = FE.fit_indexer(train, ["k"], ["k_idx"])
    got = sorted((r["k"], r["k_idx"]) for r in model.transform(test).collect())
    assert got == [("a", 0.0), ("b", 1.0)]


def test_fit_indexer_equals_string_indexer(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("a",), (None,), ("d",)], "k string")
    ours = FE.fit_indexer(df, ["k"], ["k_idx"]).labelsArray
    theirs = FE.category_indexer(["k"], ["k_idx"]).fit(df).labelsArray
    assert ours == theirs == [["a", "c", "b", "d"]]
    from pyspark.ml import Pipeline

    staged = Pipeline(stages=FE.feature_stages(["k"], ["k_idx"], ["k_idx"], "v")).fit(df.dropna())
    assert staged.stages[0].labelsArray == ours
    meta = FE.fit_indexer(df, ["k"], ["k_idx"]).transform(df).schema["k_idx"].metadata
    assert meta["ml_attr"]["type"] == "nominal" and meta["ml_attr"]["vals"] == ["a", "c", "b", "d"]


def test_multi_column_indexer_keeps_each_columns_own_labels(spark):
    """Label lists of unequal length: labels and metadata equal MLlib's own
    fit, and the transformed rows can be stored."""
    rows = [("a", "true"), ("b", "false"), ("c", "false"), ("d", "false"), ("a", "true")]
    df = spark.createDataFrame(rows, "k string, d string")
    ours = FE.fit_indexer(df, ["k", "d"], ["k_idx", "d_idx"])
    theirs = FE.category_indexer(["k", "d"], ["k_idx", "d_idx"]).fit(df)
    assert ours.labelsArray == theirs.labelsArray == [["a", "b", "c", "d"], ["false", "true"]]
    for c in ("k_idx", "d_idx"):
        assert ours.transform(df).schema[c].metadata == theirs.transform(df).schema[c].metadata
    vectors = FE.feature_assembler(["k_idx", "d_idx"], "v").transform(ours.transform(df))
    assert FE.category_sizes(vectors, "v") == {"k_idx": 4, "d_idx": 2}


def _many_kinds(spark, n):
    made = spark.range(4 * n).selectExpr("id", f"concat('k', cast(id % {n} as string)) kind", "cast(id % 24 as int) hour", "cast(id % 7 as int) district")
    return made.selectExpr("id incident_id", "cast(id % 2 as int) label", "hour", "district", "kind", "cast(id % 3 = 0 as string) domestic_str")


def test_eighty_kinds_fit_a_linear_model_and_are_reported_by_a_tree(spark):
    work = MO.prepare(_many_kinds(spark, 80))
    try:
        assert len(work.features.stages[0].labelsArray[0]) == 80
        assert MO.LOGISTIC in MO.fit_all(work.train, [MO.LOGISTIC]).models
        with pytest.raises(ValueError, match="maxBins=64.*kind_idx.*80"):
            MO.fit_all(work.train, [MO.FOREST])
    finally:
        work.release()


def test_prepare_splits_the_same_for_any_partitioning(spark):
    rows = model_rows(incidents_at(spark, SF_SMALL))
    seen = []
    for n in (1, 4, 7):
        work = MO.prepare(rows.repartition(n), partitions=n, seed=7)
        seen.append(sorted(r[0] for r in work.train.select(S.INCIDENT_ID).collect()))
        work.release()
    assert seen[0] == seen[1] == seen[2]
    other = MO.prepare(rows, seed=8)
    assert sorted(r[0] for r in other.train.select(S.INCIDENT_ID).collect()) != seen[0]
    other.release()


def test_partitions_of_the_working_set_follow_its_rows(spark, monkeypatch):
    """A task of a tree learner reads a partition whole, so a larger table has
    more of them."""
    monkeypatch.setattr(MO, "TASK_ROWS", 100)
    rows = model_rows(incidents_at(spark, SF_SMALL))
    work = MO.prepare(rows)
    try:
        assert work.labelled.rdd.getNumPartitions() == -(-rows.count() // 100)
    finally:
        work.release()


def test_rows_without_ids_are_sampled_and_split_by_their_values(spark):
    df = spark.range(2000).selectExpr("cast(null as bigint) incident_id", "cast(id as string) place")
    assert SM.hash_sample(df, "incident_id", 1.0, fallback=["place"]).count() == 2000
    assert len(SM.part_sizes(SM.hash_split(df, "incident_id")).collect()) == 1  # no columns named: one fate
    assert SM.hash_sample(df, "incident_id", 1.0, fallback=["place"]).count() == 2000
    assert len(SM.part_sizes(SM.hash_split(df, "incident_id")).collect()) == 1  # no columns named: one fate
    sizes = {r["part"]: r["n_rows"] for r in SM.part_sizes(SM.hash_split(df, "incident_id", fallback=["place"])).collect()}
    assert sum(sizes.values()) == 2000 and abs(sizes["train"] / 2000 - 0.8) < 0.05


def test_text_bar_rounding(spark):
    df = spark.createDataFrame([(0.7712,), (0.0807,), (0.0763,), (0.0718,), (0.01,), (0.03,), (0.0,)], "v double")
    got = [len(r[0]) for r in df.select(text_bar("v")).collect()]
    # Python's round: 38.56 -> 39, 4.035 -> 4, 0.5 -> 0 (half to even), 1.5 -> 2.
    assert got == [round(v * 50) for v in (0.7712, 0.0807, 0.0763, 0.0718, 0.01, 0.03, 0.0)]


def test_reconcile_counts_missing_keys_and_null(spark):
    a = spark.createDataFrame([("x", 3), ("y", 2), (None, 1)], "k string, n long")
    b = spark.createDataFrame([("x", 1), ("z", 5), (None, 4)], "k string, n long")
    got = {r["k"]: (r["left_rows"], r["right_rows"], r["delta"]) for r in R.reconcile_counts(a, b, "k", "n", "n").collect()}
    assert got == {"x": (3, 1, 2), "y": (2, 0, 2), "z": (0, 5, -5), None: (1, 4, -3)}


@pytest.fixture(scope="module")
def small_fits(spark):
    rows = model_rows(incidents_at(spark, SF_SMALL))
    _, test = SM.hash_parts(rows, S.INCIDENT_ID)
    work = MO.prepare(rows)
    assert work.rows["test"] == test.count() and sum(work.rows.values()) == rows.count()
    assert work.kept["test"] == work.test.count() and work.kept["train"] == work.train.count()
    fitted = MO.fit_all(work.train, [MO.LOGISTIC, MO.FOREST], MO.FittedSet(features=work.features))
    yield fitted, work.train, work.test, test
    work.release()


def test_confusion_total_is_scored_rows(spark, small_fits):
    from blotter.operators import metrics as M

    fitted, tr, te, test = small_fits
    scored = MO.score_all(fitted, te, [MO.LOGISTIC, MO.FOREST])
    q = {r["model"]: r["tn"] + r["fp"] + r["fn"] + r["tp"] for r in M.outcome_cells(scored, by=["model"]).collect()}
    assert q[MO.LOGISTIC] == q[MO.FOREST] == te.count() <= test.count()


def test_forest_beats_logistic_and_importances(spark, small_fits):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    from blotter.operators import metrics as M

    fitted, tr, te, _ = small_fits
    scored = MO.score_all(fitted, te, [MO.LOGISTIC, MO.FOREST])
    auc = {r["model"]: r["auc"] for r in M.auc_roc(scored, by=["model"]).collect()}
    assert auc[MO.FOREST] > auc[MO.LOGISTIC]
    ev = BinaryClassificationEvaluator(labelCol="label", numBins=0)
    assert auc[MO.FOREST] == pytest.approx(ev.evaluate(fitted.models[MO.FOREST].transform(te)), abs=1e-9)
    imp = MO.importances(fitted.models[MO.FOREST])
    assert [n for n, _ in imp] == list(FE.FEATURE_ORDER)
    assert sum(v for _, v in imp) == pytest.approx(1.0)
    table = R.importance_table(spark, imp).collect()
    assert table[0]["feature"] == FE.KIND_IDX


def test_job_end_to_end(spark, tmp_shared):
    from blotter.plans.job import parse_args, run

    out = os.path.join(tmp_shared, "report")
    args = parse_args(["--events", f"{SF_SMALL}/events.parquet", "--out", out, "--models", "LogisticRegression,RandomForest"])
    summary = run(spark, args)
    assert summary["train_rows"] > summary["test_rows"] > 0
    for name in ("profile", "kind_counts", "place_hotspots", "year_counts", "overall_rate", "arrest_rate_by_kind",
                 "working_set", "model_metrics", "metrics_table", "best_model", "feature_importances"):
        assert spark.read.parquet(os.path.join(out, name)).count() > 0, name
    rec = spark.read.parquet(os.path.join(out, "model_metrics")).collect()
    assert all(r["skipped_rows"] >= 0 for r in rec)


def test_job_from_csv_with_bernoulli_sample(spark, tmp_shared):
    """The job's CSV entry point: raw rows written with the source header
    names, read back, sampled with the seeded sampler and split by the seed."""
    from blotter.plans.job import parse_args, run
    from blotter.sources.incidents import raw_incidents
    from blotter.sources.ingest import write_incident_csv

    csv = os.path.join(tmp_shared, "incidents_csv")
    write_incident_csv(raw_incidents(spark.read.parquet(f"{SF_MID}/events.parquet")), csv)
    out = os.path.join(tmp_shared, "report_csv")
    args = parse_args([
        "--csv", csv, "--out", out, "--models", "LogisticRegression",
        "--sample", "0.5", "--sampler", "bernoulli", "--seed", "3",
    ])
    summary = run(spark, args)
    assert 0 < summary["test_rows"] < summary["train_rows"] < 10000
    counts = {r["kind"]: r["n_rows"] for r in spark.read.parquet(os.path.join(out, "kind_counts")).collect()}
    assert sum(counts.values()) == 10000


def test_job_parses_csv_once_into_parquet(spark, tmp_shared):
    """After ``load`` a CSV source is a Parquet table in the shared folder,
    so each analysis scans only its own columns instead of every line."""
    from blotter.operators import analytics as A
    from blotter.plans.job import load, parse_args
    from blotter.sources.incidents import raw_incidents
    from blotter.sources.ingest import write_incident_csv

    csv = os.path.join(tmp_shared, "incidents_csv_once")
    write_incident_csv(raw_incidents(spark.read.parquet(f"{SF_SMALL}/events.parquet")), csv)
    base = load(spark, parse_args(["--csv", csv, "--out", os.path.join(tmp_shared, "unused")]))
    plan = A.kind_counts(base)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "FileScan csv" not in plan
    assert "ReadSchema: struct<kind:string>" in plan
    assert base.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()


def test_job_without_ids_trains(spark, tmp_shared):
    from blotter.plans.job import parse_args, run
    from blotter.sources.incidents import raw_incidents
    from blotter.sources.ingest import write_incident_csv

    csv = os.path.join(tmp_shared, "no_ids_csv")
    write_incident_csv(raw_incidents(spark.read.parquet(f"{SF_SMALL}/events.parquet")).drop(S.INCIDENT_ID), csv)
    args = parse_args(["--csv", csv, "--out", os.path.join(tmp_shared, "no_ids"), "--models", "LogisticRegression", "--sample", "0.9"])
    summary = run(spark, args)
    assert summary["train_rows"] > summary["test_rows"] > 0


def test_entry_script_runs_from_another_folder(tmp_path):
    """The documented submit line, on synthetic rows, started elsewhere."""
    import subprocess
    import sys

    script = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "blotter_job.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    line = [sys.executable, script, "--synthetic", "2000", "--out", str(tmp_path / "out"), "--models", "LogisticRegression", "--master", "local[2]"]
    done = subprocess.run(line, cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "best_model" in done.stdout
    assert (tmp_path / "out" / "best_model").exists()
