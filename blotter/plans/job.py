"""Batch job: ingest, the four analyses, sampling, features, three
classifiers, metrics and importances, each written as a Parquet table.

    spark-submit blotter_job.py --events s3a://data/events.parquet --out s3a://reports/run1

The data source is an explicit argument (CSV, Parquet, an events table, or a
number of synthetic rows). A CSV source is parsed once into a Parquet table
under the shared checkpoint folder, which every later step reads. Report tables are small (one row per category, model or metric) and are written as
single files; the input is never collected.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators import analytics as A
from blotter.operators import metrics as M
from blotter.operators import models as MO
from blotter.operators import report as R
from blotter.operators import sampling as SM
from blotter.session import ensure_checkpoint_dir, open_session, shared_dir
from blotter.sources import ingest as I
from blotter.sources import schema as S
from blotter.sources.incidents import incidents
from blotter.sources.synth import synthetic_incidents


def parse_args(argv):
    p = argparse.ArgumentParser(prog="blotter-job")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="incident CSV (header names of the city export)")
    src.add_argument("--parquet", help="incident Parquet with canonical raw columns")
    src.add_argument("--events", help="events Parquet; incidents are derived from it")
    src.add_argument("--synthetic", type=int, metavar="N", help="N synthetic incidents instead of a data source")
    p.add_argument("--out", required=True, help="output folder on shared storage")
    p.add_argument("--sample", type=float, default=None, help="fraction to model on (default: all rows)")
    p.add_argument("--sampler", choices=["hash", "bernoulli"], default="hash")
    p.add_argument("--seed", type=int, default=42, help="seed of the sample and of the train/test split")
    p.add_argument("--models", default=",".join(MO.RECIPE))
    p.add_argument("--min-rows", type=int, default=100)
    p.add_argument("--master", default=None, help="only for local runs")
    p.add_argument("--show", type=int, default=0, help="also print the first N rows of each report")
    p.add_argument(
        "--shuffle-partitions",
        type=int,
        default=None,
        help="upper bound of shuffle partitions (AQE coalesces down); about input bytes / 128 MB at scale",
    )
    return p.parse_args(argv)


def load(spark: SparkSession, args) -> DataFrame:
    if args.csv:
        # Text has no column pruning, so each analysis below would parse
        # every line again. Parse once into a Parquet table in the shared
        # folder and read that (pruned columns, pushed filters) from here
        # on; the written table also cuts the lineage back to the text.
        staged = shared_dir(spark, "incidents")
        I.standardise(I.read_incident_csv(spark, args.csv)).write.parquet(staged)
        return spark.read.parquet(staged)
    if args.parquet:
        return I.standardise(spark.read.parquet(args.parquet))
    if args.synthetic is not None:
        made = synthetic_incidents(spark.range(args.synthetic), "id")
        return made.withColumn(S.DOMESTIC, F.col(S.DOMESTIC_STR).cast("boolean"))
    return incidents(spark.read.parquet(args.events))


def _write(df: DataFrame, out: str, name: str, show: int = 0) -> None:
    """Write a small report table as one file; optionally print it back.
    ``coalesce(1)`` keeps a sorted report's order; the sorted reports have a
    range exchange below it, so only the sort of the small result runs in
    one task, not the aggregate."""
    path = f"{out.rstrip('/')}/{name}"
    df.coalesce(1).write.mode("overwrite").parquet(path)
    if show:
        print(f"-- {name}")
        df.sparkSession.read.parquet(path).show(show, truncate=False)


def write_reports(base: DataFrame, out: str, min_rows: int, show: int = 0) -> list[str]:
    """The analyses over every row, one table each under ``out``; their names."""
    spark = base.sparkSession
    A.register_view(base, "incident_events")
    reports = {
        "profile": I.profile(base),
        "kind_counts": A.kind_counts(base),
        "place_hotspots": A.place_hotspots_sql(spark, "incident_events", 10),
        "year_counts": A.year_counts(base),
        "overall_rate": A.overall_rate(base),
        "arrest_rate_by_kind": A.arrest_rate_by_kind(base, min_rows),
    }
    for name, df in reports.items():
        _write(df, out, name, show)
    return list(reports)


def run(spark: SparkSession, args) -> dict:
    """The whole run; returns the small in-memory summary it also prints."""
    # Iterative learners checkpoint into the shared folder (GBT every 10
    # rounds); on a cluster it must be configured.
    ensure_checkpoint_dir(spark)
    base = load(spark, args)
    out = args.out
    summary = {}
    write_reports(base, out, args.min_rows, args.show)

    # Working set for the models.
    rows = S.with_column_if_missing(base, S.DOMESTIC_STR, lambda d: F.col(S.DOMESTIC).cast("string"))
    rows = S.complete_rows(rows)
    if args.sample:
        if args.sampler == "hash":
            rows = SM.hash_sample(rows, S.INCIDENT_ID, args.sample, f"sample:{args.seed}", MO.MODEL_COLUMNS)
        else:
            rows = SM.bernoulli_sample(rows, args.sample, args.seed)

    names = [n for n in args.models.split(",") if n]
    work = MO.prepare(rows, seed=args.seed)
    try:
        skipped = {n: work.rows[n] - work.kept[n] for n in work.rows}
        sizes = [("sample", sum(work.rows.values()), sum(work.kept.values()), sum(skipped.values()))]
        sizes += [(n, work.rows[n], work.kept[n], skipped[n]) for n in ("train", "test")]
        _write(spark.createDataFrame(sizes, "part string, n_rows long, kept_rows long, skipped_rows long"), out, "working_set", args.show)
        summary |= {"train_rows": work.kept["train"], "test_rows": work.kept["test"], "test_rows_skipped": skipped["test"]}
        fitted = MO.fit_all(work.train, names, MO.FittedSet(features=work.features))
        scored = MO.score_all(fitted, work.test, names)
        secs = spark.createDataFrame([(n, float(fitted.train_s[n])) for n in names], "model string, train_s double")
        metrics = M.metrics_record(scored, by=["model"], with_confusion=True).join(F.broadcast(secs), "model")
        _write(metrics.withColumn("skipped_rows", F.lit(skipped["test"]).cast("long")), out, "model_metrics", args.show)
        # every later table reads the few rows just written
        rec = spark.read.parquet(f"{out.rstrip('/')}/model_metrics")
        _write(M.metrics_pivot(M.metrics_long(rec, metrics=(*M.METRIC_NAMES, "train_s")), names), out, "metrics_table", args.show)
        _write(M.best_by(rec, "auc").select("model", "auc"), out, "best_model", args.show)
        best = spark.read.parquet(f"{out.rstrip('/')}/best_model").first()
        summary["best_model"] = (best["model"], best["auc"])
        summary["train_s"] = dict(fitted.train_s)
        if MO.FOREST in fitted.models:
            _write(R.importance_table(spark, MO.importances(fitted.models[MO.FOREST])), out, "feature_importances", args.show)
    finally:
        work.release()
    return summary


def main(argv=None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    extra = {"spark.sql.shuffle.partitions": str(args.shuffle_partitions)} if args.shuffle_partitions else None
    spark = open_session("blotter-job", master=args.master, extra=extra)
    try:
        summary = run(spark, args)
        for k, v in summary.items():
            print(f"{k}: {v}")
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
