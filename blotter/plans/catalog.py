"""Registered queries and their DuckDB oracles.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the provided
Parquet tables (or data Spark derives from them) and runs over whole tables.
``ORACLES[name]`` is DuckDB SQL over the same tables for the queries SQL can
express; queries without an oracle are model fits and seeded samplers, which
are checked by row counts and by the invariants in ``tests/``.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.columns import hash_uniform, hour_of_text
from blotter.operators import analytics as A
from blotter.operators import features as FE
from blotter.operators import logistic as L
from blotter.operators import metrics as M
from blotter.operators import models as MO
from blotter.operators import report as R
from blotter.operators import sampling as SM
from blotter.operators import trees as T
from blotter.plans import job as J
from blotter.session import shared_dir
from blotter.sources import ingest as I
from blotter.sources import schema as S
from blotter.sources.incidents import INCIDENTS_SQL, KIND_RATES, duck_uniform, incidents, lookup, raw_incidents
from blotter.sources.synth import (
    SYNTH_DISTRICTS,
    SYNTH_DOMESTIC_SHARE,
    SYNTH_KIND_RATES,
    SYNTH_PLACES,
    SYNTH_YEARS,
    synthetic_incidents,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

WITH_INCIDENTS = "WITH " + INCIDENTS_SQL


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# Lazy plans (not data) per (application, folder, name): DataFrames are
# immutable, so queries of one run share the parsed footers and the view's
# expression tree instead of rebuilding them through Py4J each time.
_PLANS: dict = {}


def _plan(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    df = _PLANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _PLANS[key] = make()
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _plan(spark, sf_dir, name, lambda: spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def incidents_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plan(spark, sf_dir, "__incidents", lambda: incidents(table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- analytics


@register(
    "kind_counts",
    WITH_INCIDENTS + " SELECT kind, COUNT(*) AS n_rows FROM incidents GROUP BY kind",
)
def q_kind_counts(spark, sf_dir):
    return A.kind_counts(incidents_at(spark, sf_dir))


@register(
    "kind_top10",
    WITH_INCIDENTS
    + " SELECT kind, COUNT(*) AS n_rows FROM incidents GROUP BY kind ORDER BY n_rows DESC, kind LIMIT 10",
)
def q_kind_top10(spark, sf_dir):
    return A.top_n(A.kind_counts(incidents_at(spark, sf_dir)), 10)


@register(
    "kind_top3",
    WITH_INCIDENTS
    + " SELECT kind, COUNT(*) AS n_rows FROM incidents GROUP BY kind ORDER BY n_rows DESC, kind LIMIT 3",
)
def q_kind_top3(spark, sf_dir):
    return A.top_n(A.kind_counts(incidents_at(spark, sf_dir)), 3)


_HOTSPOTS_ORACLE = (
    WITH_INCIDENTS
    + " SELECT place, COUNT(*) AS hits FROM incidents WHERE place IS NOT NULL"
    " GROUP BY place ORDER BY hits DESC, place LIMIT 10"
)


@register("place_hotspots", _HOTSPOTS_ORACLE)
def q_place_hotspots(spark, sf_dir):
    return A.place_hotspots(incidents_at(spark, sf_dir), n=10)


@register("place_hotspots_sql", _HOTSPOTS_ORACLE)
def q_place_hotspots_sql(spark, sf_dir):
    # one view name per dataset, so queries over two folders never collide
    view = A.register_view(incidents_at(spark, sf_dir), f"incident_events_{zlib.crc32(sf_dir.encode()):08x}")
    return A.place_hotspots_sql(spark, view, n=10)


@register(
    "year_counts",
    WITH_INCIDENTS + " SELECT year, COUNT(*) AS n_rows FROM incidents GROUP BY year",
)
def q_year_counts(spark, sf_dir):
    return A.year_counts(incidents_at(spark, sf_dir))


@register(
    "year_counts_nonnull",
    WITH_INCIDENTS + " SELECT year, COUNT(*) AS n_rows FROM incidents WHERE year IS NOT NULL GROUP BY year",
)
def q_year_counts_nonnull(spark, sf_dir):
    return A.drop_incomplete(A.year_counts(incidents_at(spark, sf_dir)))


@register(
    "order_year_counts",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_rows FROM orders GROUP BY 1",
)
def q_order_year_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return A.year_counts(orders, F.year("o_orderdate").cast("int"), name="year")


@register(
    "source_top10",
    "SELECT source, COUNT(*) AS n_rows FROM documents GROUP BY source ORDER BY n_rows DESC, source NULLS FIRST LIMIT 10",
)
def q_source_top10(spark, sf_dir):
    """Twenty sources, several of equal size: the cut and its tie-break."""
    return A.top_n(A.counts_by(table(spark, sf_dir, "documents"), "source"), 10)


@register(
    "customer_hotspots",
    "SELECT CAST(o_custkey AS VARCHAR) AS place, COUNT(*) AS hits FROM orders WHERE o_custkey IS NOT NULL"
    " GROUP BY o_custkey ORDER BY hits DESC, place LIMIT 10",
)
def q_customer_hotspots(spark, sf_dir):
    """The hotspot cut over more groups than it keeps."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("customer"))
    return A.place_hotspots(orders, 10, place="customer")


@register(
    "order_status_counts",
    "SELECT o_orderstatus, COUNT(*) AS n_rows FROM orders GROUP BY o_orderstatus",
)
def q_order_status_counts(spark, sf_dir):
    return A.counts_by(table(spark, sf_dir, "orders"), "o_orderstatus")


@register(
    "overall_arrest_rate",
    WITH_INCIDENTS
    + """ SELECT COUNT(*) AS n_rows,
                 COUNT(*) FILTER (WHERE arrest) AS n_arrests,
                 CAST(COUNT(*) FILTER (WHERE arrest) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0) AS arrest_rate,
                 round(100.0 * CAST(COUNT(*) FILTER (WHERE arrest) AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0), 2) AS arrest_pct
          FROM incidents""",
)
def q_overall_arrest_rate(spark, sf_dir):
    return A.overall_rate(incidents_at(spark, sf_dir))


@register(
    "arrest_rate_by_kind",
    WITH_INCIDENTS
    + """ SELECT kind, COUNT(*) AS n_rows, AVG(CAST(label AS DOUBLE)) AS arrest_rate
          FROM incidents GROUP BY kind HAVING COUNT(*) >= 100""",
)
def q_arrest_rate_by_kind(spark, sf_dir):
    return A.arrest_rate_by_kind(incidents_at(spark, sf_dir), min_rows=100)


@register(
    "arrest_rate_by_place",
    WITH_INCIDENTS
    + """ SELECT place, COUNT(*) AS n_rows, AVG(CAST(label AS DOUBLE)) AS arrest_rate
          FROM incidents GROUP BY place HAVING COUNT(*) >= 100""",
)
def q_arrest_rate_by_place(spark, sf_dir):
    return A.rate_by(incidents_at(spark, sf_dir), S.PLACE, min_rows=100)


_INCIDENT_COLS = "incident_id, occurred_text, kind, place, hour, district, year, domestic, arrest, label"


@register("arrest_rows", WITH_INCIDENTS + f" SELECT {_INCIDENT_COLS} FROM incidents WHERE arrest = true")
def q_arrest_rows(spark, sf_dir):
    return A.arrest_rows(incidents_at(spark, sf_dir))


# ------------------------------------------------------------------- ingest


@register("csv_ingest", WITH_INCIDENTS + f" SELECT {_INCIDENT_COLS} FROM incidents")
def q_csv_ingest(spark, sf_dir):
    """Round trip through CSV: write the raw rows with the source header
    names (quoted commas, empty cells for NULL) to the shared folder, read
    them back with the fixed column map and standardise."""
    path = shared_dir(spark, "csv-ingest")
    I.write_incident_csv(raw_incidents(table(spark, sf_dir, "events")), path)
    back = I.standardise(I.read_incident_csv(spark, path))
    return back.select(*[c.strip() for c in _INCIDENT_COLS.split(",")])


@register(
    "incident_standardise",
    WITH_INCIDENTS + " SELECT incident_id, hour, label, CAST(domestic AS VARCHAR) AS domestic_str FROM incidents",
)
def q_incident_standardise(spark, sf_dir):
    raw = raw_incidents(table(spark, sf_dir, "events"))
    return I.standardise(raw).select(S.INCIDENT_ID, S.HOUR, S.LABEL, S.DOMESTIC_STR)


@register(
    "hour_of_day",
    WITH_INCIDENTS
    + """ SELECT incident_id, occurred_text,
                 CAST(hour(strptime(occurred_text, '%m/%d/%Y %I:%M:%S %p')) AS INTEGER) AS hour
          FROM incidents""",
)
def q_hour_of_day(spark, sf_dir):
    raw = raw_incidents(table(spark, sf_dir, "events"))
    return raw.select(S.INCIDENT_ID, S.OCCURRED_TEXT, hour_of_text(S.OCCURRED_TEXT).alias(S.HOUR))


_PROFILE_TYPES = [
    ("incident_id", "bigint"), ("occurred_text", "string"), ("kind", "string"), ("place", "string"),
    ("hour", "int"), ("district", "int"), ("year", "int"), ("domestic", "boolean"),
    ("arrest", "boolean"), ("label", "int"),
]
_PROFILE_ORACLE = WITH_INCIDENTS + " " + " UNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, true AS nullable,"
    f" COUNT(*) AS n_rows, COUNT({c}) AS non_null FROM incidents"
    for i, (c, t) in enumerate(_PROFILE_TYPES)
)


@register("ingest_profile", _PROFILE_ORACLE)
def q_ingest_profile(spark, sf_dir):
    return I.profile(incidents_at(spark, sf_dir))


def _duck_list(values) -> str:
    return "[" + ", ".join(repr(v) if not isinstance(v, str) else "'" + v + "'" for v in values) + "]"


def _duck_pick(values, u: str) -> str:
    return f"({_duck_list(values)})[CAST(floor({float(len(values))!r} * {u}) AS INTEGER) + 1]"


_SYNTH_RATE_CASE = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in SYNTH_KIND_RATES.items()) + " END"
_SYNTH_ARREST = (
    f"u_arrest < least(0.99::DOUBLE, greatest(0.01::DOUBLE, ({_SYNTH_RATE_CASE} + CASE WHEN domestic THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END)"
    " - CASE WHEN hour BETWEEN 2 AND 5 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END))"
)
_SYNTH_ORACLE = f"""
WITH s AS (
  SELECT event_id AS incident_id,
         {_duck_pick(list(SYNTH_KIND_RATES), duck_uniform('event_id', 'kind'))} AS kind,
         CAST(floor(24.0::DOUBLE * {duck_uniform('event_id', 'hour')}) AS INTEGER) AS hour,
         {duck_uniform('event_id', 'dom')} < {SYNTH_DOMESTIC_SHARE!r}::DOUBLE AS domestic,
         CAST(floor({float(SYNTH_DISTRICTS)!r}::DOUBLE * {duck_uniform('event_id', 'district')}) + 1 AS INTEGER) AS district,
         {_duck_pick(SYNTH_PLACES, duck_uniform('event_id', 'place'))} AS place,
         CAST({_duck_pick(SYNTH_YEARS, duck_uniform('event_id', 'year'))} AS INTEGER) AS year,
         {duck_uniform('event_id', 'arrest')} AS u_arrest
  FROM events
)
SELECT incident_id, district, kind, place, year, hour,
       lower(CAST(domestic AS VARCHAR)) AS domestic_str,
       {_SYNTH_ARREST} AS arrest,
       CAST({_SYNTH_ARREST} AS INTEGER) AS label
FROM s
"""


@register("synthetic_incidents", _SYNTH_ORACLE)
def q_synthetic_incidents(spark, sf_dir):
    return synthetic_incidents(table(spark, sf_dir, "events"), "event_id")


@register(
    "synthetic_kind_counts",
    "WITH synth AS (" + _SYNTH_ORACLE + ") SELECT kind, COUNT(*) AS n_rows FROM synth GROUP BY kind",
)
def q_synthetic_kind_counts(spark, sf_dir):
    return A.kind_counts(synthetic_incidents(table(spark, sf_dir, "events"), "event_id"))


@register(
    "synthetic_rate_by_slot",
    "WITH synth AS (" + _SYNTH_ORACLE + "), slots AS (SELECT kind || ' ' || CAST(hour AS VARCHAR) AS slot, label FROM synth)"
    " SELECT slot, COUNT(*) AS n_rows, AVG(CAST(label AS DOUBLE)) AS arrest_rate FROM slots"
    " GROUP BY slot HAVING COUNT(*) >= (SELECT COUNT(*) FROM synth) // 240",
)
def q_synthetic_rate_by_slot(spark, sf_dir):
    """Rate per kind and hour, 240 groups of which the minimum support (the
    mean size) removes about half."""
    rows = synthetic_incidents(table(spark, sf_dir, "events"), "event_id")
    slots = rows.select(F.concat_ws(" ", F.col(S.KIND), F.col(S.HOUR).cast("string")).alias("slot"), S.LABEL)
    mean_size = table(spark, sf_dir, "events").count() // 240
    return A.rate_by(slots, "slot", min_rows=mean_size)


def model_rows(df: DataFrame) -> DataFrame:
    """Incidents with the text form of the domestic flag (added only if
    missing), complete in every model input column."""
    df = S.with_column_if_missing(df, S.DOMESTIC_STR, lambda d: F.col(S.DOMESTIC).cast("string"))
    return S.complete_rows(df)


@register(
    "complete_rows",
    WITH_INCIDENTS
    + f""" SELECT {_INCIDENT_COLS}, CAST(domestic AS VARCHAR) AS domestic_str FROM incidents
           WHERE district IS NOT NULL AND kind IS NOT NULL AND hour IS NOT NULL
             AND domestic IS NOT NULL AND label IS NOT NULL""",
)
def q_complete_rows(spark, sf_dir):
    return model_rows(incidents_at(spark, sf_dir))


# ----------------------------------------------------------------- sampling

_U_SAMPLE = duck_uniform("incident_id", "sample")
_U_SPLIT = duck_uniform("incident_id", "split")
_PART_SQL = f"CASE WHEN {_U_SPLIT} < 0.8::DOUBLE THEN 'train' ELSE 'test' END"


@register("hash_sample", WITH_INCIDENTS + f" SELECT {_INCIDENT_COLS} FROM incidents WHERE {_U_SAMPLE} < 0.05::DOUBLE")
def q_hash_sample(spark, sf_dir):
    return SM.hash_sample(incidents_at(spark, sf_dir), S.INCIDENT_ID, 0.05, salt="sample")


@register("hash_split", WITH_INCIDENTS + f" SELECT incident_id, {_PART_SQL} AS part FROM incidents")
def q_hash_split(spark, sf_dir):
    return SM.hash_split(incidents_at(spark, sf_dir), S.INCIDENT_ID).select(S.INCIDENT_ID, SM.PART)


@register("split_sizes", WITH_INCIDENTS + f" SELECT {_PART_SQL} AS part, COUNT(*) AS n_rows FROM incidents GROUP BY 1")
def q_split_sizes(spark, sf_dir):
    return SM.part_sizes(SM.hash_split(incidents_at(spark, sf_dir), S.INCIDENT_ID))


@register(
    "sample_split_sizes",
    WITH_INCIDENTS
    + f""", s AS (SELECT incident_id FROM incidents WHERE {_U_SAMPLE} < 0.05::DOUBLE)
          SELECT 'sample' AS part, COUNT(*) AS n_rows FROM s
          UNION ALL
          SELECT {_PART_SQL} AS part, COUNT(*) AS n_rows FROM s GROUP BY 1""",
)
def q_sample_split_sizes(spark, sf_dir):
    """Working-set report: a 5% hash sample and its train/test parts, in
    one pass (each sampled row counts once for 'sample' and once for its
    part)."""
    sample = SM.hash_sample(incidents_at(spark, sf_dir), S.INCIDENT_ID, 0.05, salt="sample")
    labelled = SM.hash_split(sample, S.INCIDENT_ID)
    both = labelled.select(F.explode(F.array(F.lit("sample"), F.col(SM.PART))).alias(SM.PART))
    return both.groupBy(SM.PART).agg(F.count(F.lit(1)).alias("n_rows"))


@register("bernoulli_sample")
def q_bernoulli_sample(spark, sf_dir):
    return SM.bernoulli_sample(incidents_at(spark, sf_dir), 0.05, seed=42)


@register("random_split")
def q_random_split(spark, sf_dir):
    return SM.labelled_random_split(incidents_at(spark, sf_dir).select(S.INCIDENT_ID), (0.8, 0.2), seed=42)


@register(
    "bernoulli_sample_facts",
    WITH_INCIDENTS + " SELECT COUNT(*) AS input_rows, 0::BIGINT AS foreign_ids, 0::BIGINT AS repeated_ids, true AS size_fits FROM incidents",
)
def q_bernoulli_sample_facts(spark, sf_dir):
    """What holds for any 5% Bernoulli sample: ids of the input, none twice,
    and a size within five standard deviations."""
    rows = incidents_at(spark, sf_dir).select(S.INCIDENT_ID)
    sample = SM.bernoulli_sample(rows, 0.05, seed=42).groupBy(S.INCIDENT_ID).agg(F.count(F.lit(1)).alias("taken"))
    both = rows.withColumn("own", F.lit(1)).join(sample, S.INCIDENT_ID, "full")
    n, k = F.count("own"), F.sum("taken")
    return both.agg(
        n.alias("input_rows"),
        F.count_if(F.col("own").isNull()).alias("foreign_ids"),
        F.count_if(F.col("taken") > 1).alias("repeated_ids"),
        (F.abs(k - n * 0.05) <= F.sqrt(n * 0.05 * 0.95) * 5).alias("size_fits"),
    )


@register(
    "random_split_facts",
    WITH_INCIDENTS + " SELECT COUNT(*) AS input_rows, COUNT(*) AS placed_rows, 0::BIGINT AS in_both, true AS size_fits FROM incidents",
)
def q_random_split_facts(spark, sf_dir):
    """What holds for any random 80/20 split: every row in exactly one part,
    and a train size within five standard deviations."""
    rows = incidents_at(spark, sf_dir).select(S.INCIDENT_ID)
    parts = SM.labelled_random_split(rows, (0.8, 0.2), seed=42).groupBy(S.INCIDENT_ID)
    parts = parts.agg(F.count(F.lit(1)).alias("times"), F.count_if(F.col(SM.PART) == "train").alias("train"))
    both = rows.join(parts, S.INCIDENT_ID, "left")
    n = F.count(F.lit(1))
    return both.agg(
        n.alias("input_rows"),
        F.count("times").alias("placed_rows"),
        F.count_if(F.col("times") > 1).alias("in_both"),
        (F.abs(F.sum("train") - n * 0.8) <= F.sqrt(n * 0.8 * 0.2) * 5).alias("size_fits"),
    )


# ------------------------------------------------------------------ metrics

# Scorers defined by expressions (no model), so metrics are SQL-checkable.
SCORER_NAMES = ("domestic_flag", "kind_rate", "kind_rate_noisy")


def _scorer(name: str):
    if name == "kind_rate_noisy":
        return lookup(F.col(S.KIND), KIND_RATES) + F.lit(0.1) * hash_uniform(S.INCIDENT_ID, "noise")
    if name == "kind_rate":
        return lookup(F.col(S.KIND), KIND_RATES)
    if name == "domestic_flag":
        return F.when(F.col(S.DOMESTIC), F.lit(0.7)).otherwise(F.lit(0.3))
    raise ValueError(name)


def scored_rows(df: DataFrame, name: str = "kind_rate_noisy") -> DataFrame:
    """(model, incident_id, label, score, prediction) for a scorer;
    prediction is 1.0 when the score is at least one half."""
    sc = _scorer(name)
    return df.select(
        F.lit(name).alias("model"),
        S.INCIDENT_ID,
        S.LABEL,
        sc.alias("score"),
        F.when(sc >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
    )


def all_scored(df: DataFrame) -> DataFrame:
    """Rows of every scorer from one scan: each input row yields one
    (model, score) entry per scorer through ``explode``."""
    entries = F.array(*[F.struct(F.lit(n).alias("model"), _scorer(n).alias("score")) for n in SCORER_NAMES])
    x = df.select(S.INCIDENT_ID, S.LABEL, F.explode(entries).alias("x"))
    sc = F.col("x.score")
    return x.select(
        F.col("x.model").alias("model"),
        S.INCIDENT_ID,
        S.LABEL,
        sc.alias("score"),
        F.when(sc >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"),
    )


_RATE_OF_KIND = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v!r}::DOUBLE" for k, v in KIND_RATES.items()) + " END"
_SCORE_SQL = {
    "kind_rate_noisy": f"{_RATE_OF_KIND} + 0.1::DOUBLE * {duck_uniform('incident_id', 'noise')}",
    "kind_rate": _RATE_OF_KIND,
    "domestic_flag": "CASE WHEN domestic THEN 0.7::DOUBLE ELSE 0.3::DOUBLE END",
}


def _scored_sql(names) -> str:
    parts = [
        f"SELECT '{n}' AS model, incident_id, label, {_SCORE_SQL[n]} AS score FROM incidents" for n in names
    ]
    return (
        "scored AS (SELECT model, incident_id, label, score, "
        "CASE WHEN score >= 0.5::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction FROM ("
        + " UNION ALL ".join(parts)
        + "))"
    )


def _metric_ctes(grouped: bool) -> str:
    g = "model, " if grouped else ""
    gb = "GROUP BY model" if grouped else ""
    pw = "PARTITION BY model" if grouped else ""
    u = " USING (model, c)" if grouped else " USING (c)"
    return f"""
conf AS (SELECT {g}CAST(label AS DOUBLE) AS l, prediction AS p, COUNT(*) AS n FROM scored
         WHERE label IS NOT NULL AND prediction IS NOT NULL GROUP BY {g}l, p),
cls AS (SELECT {g}l AS c, SUM(n) AS actual FROM conf GROUP BY {g}c),
prd AS (SELECT {g}p AS c, SUM(n) AS pred FROM conf GROUP BY {g}c),
tps AS (SELECT {g}l AS c, SUM(n) AS tp FROM conf WHERE l = p GROUP BY {g}c),
per AS (SELECT {g}c, CAST(actual AS DOUBLE) AS actual, CAST(COALESCE(pred, 0) AS DOUBLE) AS pred,
               CAST(COALESCE(tp, 0) AS DOUBLE) AS tp
        FROM cls LEFT JOIN prd{u} LEFT JOIN tps{u}),
pr AS (SELECT *, CASE WHEN pred > 0 THEN tp / pred ELSE 0.0 END AS prec,
                 CASE WHEN actual > 0 THEN tp / actual ELSE 0.0 END AS rec FROM per),
f AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2.0 * prec * rec / (prec + rec) ELSE 0.0 END AS f1c FROM pr),
wm AS (SELECT {g}SUM(tp) / SUM(actual) AS accuracy, SUM(actual * f1c) / SUM(actual) AS f1,
              SUM(actual * prec) / SUM(actual) AS weighted_precision,
              SUM(actual * rec) / SUM(actual) AS weighted_recall
       FROM f {gb}),
d AS (SELECT {g}score AS s,
             SUM(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos,
             SUM(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg
      FROM scored WHERE label IS NOT NULL AND score IS NOT NULL GROUP BY {g}s),
r AS (SELECT *, COALESCE(SUM(neg) OVER ({pw} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d),
au AS (SELECT {g}SUM(CAST(pos AS DOUBLE) * (CAST(below AS DOUBLE) + 0.5 * CAST(neg AS DOUBLE)))
              / (SUM(CAST(pos AS DOUBLE)) * SUM(CAST(neg AS DOUBLE))) AS auc
       FROM r {gb})"""


_ONE = WITH_INCIDENTS + ", " + _scored_sql(["kind_rate_noisy"]) + ", " + _metric_ctes(False)
_MANY = WITH_INCIDENTS + ", " + _scored_sql(SCORER_NAMES) + ", " + _metric_ctes(True)


def _noisy(spark, sf_dir):
    return scored_rows(incidents_at(spark, sf_dir), "kind_rate_noisy")


@register(
    "label_prediction_counts",
    WITH_INCIDENTS + ", " + _scored_sql(["kind_rate_noisy"])
    + " SELECT label, prediction, COUNT(*) AS n_rows FROM scored GROUP BY label, prediction",
)
def q_label_prediction_counts(spark, sf_dir):
    return M.confusion_counts(_noisy(spark, sf_dir))


@register(
    "confusion_quartet",
    WITH_INCIDENTS + ", " + _scored_sql(["kind_rate_noisy"])
    + """ SELECT COUNT(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
                 COUNT(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
                 COUNT(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
                 COUNT(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
          FROM scored""",
)
def q_confusion_quartet(spark, sf_dir):
    return M.outcome_cells(_noisy(spark, sf_dir))


@register("auc_roc", _ONE + " SELECT auc FROM au")
def q_auc_roc(spark, sf_dir):
    return M.auc_roc(_noisy(spark, sf_dir))


@register("metric_accuracy", _ONE + " SELECT accuracy FROM wm")
def q_metric_accuracy(spark, sf_dir):
    return M.weighted_metrics(_noisy(spark, sf_dir)).select("accuracy")


@register("metric_f1", _ONE + " SELECT f1 FROM wm")
def q_metric_f1(spark, sf_dir):
    return M.weighted_metrics(_noisy(spark, sf_dir)).select("f1")


@register("metric_precision", _ONE + " SELECT weighted_precision FROM wm")
def q_metric_precision(spark, sf_dir):
    return M.weighted_metrics(_noisy(spark, sf_dir)).select("weighted_precision")


@register("metric_recall", _ONE + " SELECT weighted_recall FROM wm")
def q_metric_recall(spark, sf_dir):
    return M.weighted_metrics(_noisy(spark, sf_dir)).select("weighted_recall")


@register(
    "metrics_record",
    _ONE + " SELECT auc, accuracy, f1, weighted_precision, weighted_recall FROM au, wm",
)
def q_metrics_record(spark, sf_dir):
    return M.metrics_record(_noisy(spark, sf_dir))


@register(
    "scorer_metrics",
    _MANY + " SELECT model, auc, accuracy, f1, weighted_precision, weighted_recall FROM au JOIN wm USING (model)",
)
def q_scorer_metrics(spark, sf_dir):
    return M.metrics_record(all_scored(incidents_at(spark, sf_dir)), by=["model"])


_PIVOT_ORACLE = (
    _MANY
    + ", rec AS (SELECT model, auc, accuracy, f1, weighted_precision, weighted_recall FROM au JOIN wm USING (model)),"
    + " lng AS ("
    + " UNION ALL ".join(f"SELECT model, '{m}' AS metric, {m} AS value FROM rec" for m in M.METRIC_NAMES)
    + ") SELECT metric, "
    + ", ".join(f"MAX(value) FILTER (WHERE model = '{n}') AS {n}" for n in SCORER_NAMES)
    + " FROM lng GROUP BY metric"
)


@register("metrics_pivot", _PIVOT_ORACLE)
def q_metrics_pivot(spark, sf_dir):
    rec = M.metrics_record(all_scored(incidents_at(spark, sf_dir)), by=["model"])
    return M.metrics_pivot(M.metrics_long(rec), SCORER_NAMES)


@register(
    "best_model",
    _MANY + " SELECT model, auc FROM au ORDER BY auc DESC, model LIMIT 1",
)
def q_best_model(spark, sf_dir):
    rec = M.metrics_record(all_scored(incidents_at(spark, sf_dir)), by=["model"])
    return M.best_by(rec, "auc").select("model", "auc")


# ----------------------------------------------------------------- features

_COMPLETE_SQL = (
    "cr AS (SELECT *, CAST(domestic AS VARCHAR) AS domestic_str FROM incidents"
    " WHERE district IS NOT NULL AND kind IS NOT NULL AND hour IS NOT NULL"
    " AND domestic IS NOT NULL AND label IS NOT NULL)"
)


def _index_sql(value: str, index: str, src: str) -> str:
    return (
        f"SELECT {value}, CAST(row_number() OVER (ORDER BY n DESC, {value}) - 1 AS DOUBLE) AS {index}"
        f" FROM (SELECT {value}, COUNT(*) AS n FROM {src} WHERE {value} IS NOT NULL GROUP BY {value})"
    )


@register(
    "kind_index",
    WITH_INCIDENTS + ", " + _COMPLETE_SQL
    + f", ix AS ({_index_sql('kind', 'kind_idx', 'cr')})"
    " SELECT kind, kind_idx, COUNT(*) AS n_rows FROM cr JOIN ix USING (kind) GROUP BY kind, kind_idx",
)
def q_kind_index(spark, sf_dir):
    rows = model_rows(incidents_at(spark, sf_dir))
    model = FE.fit_indexer(rows, [S.KIND], [FE.KIND_IDX])
    return FE.index_counts(model.transform(rows), S.KIND, FE.KIND_IDX)


@register(
    "domestic_index",
    WITH_INCIDENTS + ", " + _COMPLETE_SQL
    + f", ix AS ({_index_sql('domestic_str', 'domestic_idx', 'cr')})"
    " SELECT domestic_str, domestic_idx, COUNT(*) AS n_rows FROM cr JOIN ix USING (domestic_str)"
    " GROUP BY domestic_str, domestic_idx",
)
def q_domestic_index(spark, sf_dir):
    rows = model_rows(incidents_at(spark, sf_dir))
    model = FE.fit_indexer(rows, [S.DOMESTIC_STR], [FE.DOMESTIC_IDX])
    return FE.index_counts(model.transform(rows), S.DOMESTIC_STR, FE.DOMESTIC_IDX)


@register(
    "unseen_category_skip",
    WITH_INCIDENTS
    + f", sp AS (SELECT *, {_PART_SQL} AS part FROM incidents),"
    + " tr AS (SELECT * FROM sp WHERE part = 'train'),"
    + f" ix AS ({_index_sql('place', 'place_idx', 'tr')})"
    " SELECT place, place_idx, COUNT(*) AS n_rows FROM sp JOIN ix USING (place)"
    " WHERE part = 'test' GROUP BY place, place_idx",
)
def q_unseen_category_skip(spark, sf_dir):
    """Index fitted on the train part, applied to the test part: test rows
    whose place is NULL or absent from train are skipped."""
    train, test = SM.hash_parts(incidents_at(spark, sf_dir), S.INCIDENT_ID)
    model = FE.fit_indexer(train, [S.PLACE], ["place_idx"])
    return FE.index_counts(model.transform(test), S.PLACE, "place_idx")


@register(
    "unseen_length_skip",
    "WITH d AS (SELECT doc_id, CAST(n_chars AS VARCHAR) AS size_text, CASE WHEN "
    + duck_uniform("doc_id", "split")
    + " < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part FROM documents),"
    + " tr AS (SELECT * FROM d WHERE part = 'train'),"
    + f" ix AS ({_index_sql('size_text', 'size_idx', 'tr')})"
    " SELECT size_text, size_idx, COUNT(*) AS n_rows FROM d JOIN ix USING (size_text) WHERE part = 'test' GROUP BY size_text, size_idx",
)
def q_unseen_length_skip(spark, sf_dir):
    """An index of many hundred categories, applied to rows of which many
    have a category that is truly absent from the train part."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("string").alias("size_text"))
    train, test = SM.hash_parts(docs, "doc_id")
    model = FE.fit_indexer(train, ["size_text"], ["size_idx"])
    return FE.index_counts(model.transform(test), "size_text", "size_idx")


@register(
    "feature_vector",
    WITH_INCIDENTS + ", " + _COMPLETE_SQL
    + f", ik AS ({_index_sql('kind', 'kind_idx', 'cr')}), id AS ({_index_sql('domestic_str', 'domestic_idx', 'cr')})"
    " SELECT incident_id, label, CAST(hour AS DOUBLE) AS f_hour, CAST(district AS DOUBLE) AS f_district,"
    " kind_idx AS f_kind_idx, domestic_idx AS f_domestic_idx"
    " FROM cr JOIN ik USING (kind) JOIN id USING (domestic_str)",
)
def q_feature_vector(spark, sf_dir):
    rows = model_rows(incidents_at(spark, sf_dir))
    fmodel = FE.fit_features(rows)
    vec = fmodel.transform(rows).select(S.INCIDENT_ID, S.LABEL, FE.FEATURES)
    return FE.vector_elements(vec, FE.FEATURES, FE.FEATURE_ORDER)


@register(
    "feature_inspect",
    WITH_INCIDENTS + ", " + _COMPLETE_SQL
    + f", tr AS (SELECT * FROM cr WHERE {_PART_SQL} = 'train')"
    + f", ik AS ({_index_sql('kind', 'kind_idx', 'tr')}), id AS ({_index_sql('domestic_str', 'domestic_idx', 'tr')})"
    " SELECT kind, kind_idx, hour, district, domestic_str, domestic_idx,"
    " [CAST(hour AS DOUBLE), CAST(district AS DOUBLE), kind_idx, domestic_idx] AS features, label"
    " FROM tr JOIN ik USING (kind) JOIN id USING (domestic_str)",
)
def q_feature_inspect(spark, sf_dir):
    """Indexes and the assembled vector of the training rows, the indexes
    fitted on those rows."""
    train, _ = SM.hash_parts(model_rows(incidents_at(spark, sf_dir)), S.INCIDENT_ID)
    fmodel = FE.fit_features(train)
    return fmodel.transform(train).select(
        S.KIND, FE.KIND_IDX, S.HOUR, S.DISTRICT, S.DOMESTIC_STR, FE.DOMESTIC_IDX,
        vector_to_array(FE.FEATURES).alias(FE.FEATURES), S.LABEL,
    )


# ------------------------------------------------------------------- models

_FITS: dict = {}


def fitted_models(spark, sf_dir: str, names=MO.RECIPE):
    """Train/test from a hash split of the complete incident rows; the
    feature part is fitted once, classifiers on its output. Fitted models are
    kept per (application, data), so several reports of one run share the
    fits and the persisted rows until ``release_fits``."""
    key = (spark.sparkContext.applicationId, sf_dir)
    entry = _FITS.get(key)
    if entry is None:
        work = MO.prepare(model_rows(incidents_at(spark, sf_dir)))
        entry = _FITS[key] = {"fitted": MO.FittedSet(features=work.features), "work": work}
    MO.fit_all(entry["work"].train, names, entry["fitted"])
    return entry


def release_fits() -> None:
    """Forget the fitted models and free their persisted rows."""
    while _FITS:
        _FITS.popitem()[1]["work"].release()


def fitted_scores(spark, sf_dir: str, names) -> DataFrame:
    """The scored test rows of the named classifiers, from one table per model
    in the shared folder: every report of a run reads what was scored once."""
    entry = fitted_models(spark, sf_dir, names)
    tables = entry.setdefault("scores", {})
    for n in names:
        if n not in tables:
            tables[n] = shared_dir(spark, f"scores-{n}")
            MO.score(entry["fitted"].models[n], entry["work"].test, n).write.parquet(tables[n])
    return spark.read.parquet(*[tables[n] for n in names])


def fitted_nodes(spark, sf_dir: str, name: str) -> DataFrame:
    """The node table of a fitted tree ensemble, saved once per fit."""
    entry = fitted_models(spark, sf_dir, [name])
    saved = entry.setdefault("saved", {})
    if name not in saved:
        saved[name] = T.save_ensemble(spark, entry["fitted"].models[name])
    return T.node_table(spark, saved[name], kind=T.ensemble_kind(entry["fitted"].models[name]))


def model_records(spark, sf_dir: str, names) -> DataFrame:
    """One metric record per model on the test part (the scored rows are
    read once by ``metrics_record``), with its fit seconds."""
    fitted = fitted_models(spark, sf_dir, names)["fitted"]
    rec = M.metrics_record(fitted_scores(spark, sf_dir, names), by=["model"], with_confusion=True)
    secs = spark.createDataFrame([(n, float(fitted.train_s[n])) for n in names], "model string, train_s double")
    return rec.join(F.broadcast(secs), "model")


# What SQL can state of the fits: which rows were trained on and scored.
_TRAIN_TEST_SQL = (
    WITH_INCIDENTS + ", " + _COMPLETE_SQL + f", sp AS (SELECT *, {_PART_SQL} AS part FROM cr),"
    + f" ik AS ({_index_sql('kind', 'kind_idx', '(SELECT * FROM sp WHERE part = ' + chr(39) + 'train' + chr(39) + ')')}),"
    + f" id AS ({_index_sql('domestic_str', 'domestic_idx', '(SELECT * FROM sp WHERE part = ' + chr(39) + 'train' + chr(39) + ')')}),"
    + " kept AS (SELECT sp.* FROM sp JOIN ik USING (kind) JOIN id USING (domestic_str))"
)


@register(
    "model_test_rows",
    _TRAIN_TEST_SQL
    + ", facts AS (SELECT COUNT(*) AS scored_rows, SUM(label)::BIGINT AS positives, (COUNT(*) - SUM(label))::BIGINT AS negatives FROM kept WHERE part = 'test'),"
    " al AS (SELECT COUNT(*) AS n FROM sp WHERE part = 'test')"
    " SELECT m.model, scored_rows, positives, negatives, al.n - scored_rows AS skipped_rows"
    " FROM (VALUES ('" + "'), ('".join(MO.RECIPE) + "')) m(model), facts, al",
)
def q_model_test_rows(spark, sf_dir):
    """Per fitted classifier: rows scored, their labels, and test rows that
    the indexers skipped."""
    entry = fitted_models(spark, sf_dir)
    work = entry["work"]
    scored = MO.score_all(entry["fitted"], work.test, MO.RECIPE)
    skipped = work.rows["test"] - work.kept["test"]
    return scored.groupBy("model").agg(
        F.count(F.lit(1)).alias("scored_rows"),
        F.sum(F.col(S.LABEL)).cast("long").alias("positives"),
        F.sum(1 - F.col(S.LABEL)).cast("long").alias("negatives"),
        F.lit(skipped).cast("long").alias("skipped_rows"),
    )


@register("model_train_ids", _TRAIN_TEST_SQL + " SELECT incident_id, label FROM kept WHERE part = 'train'")
def q_model_train_ids(spark, sf_dir):
    """The rows that the classifiers were fitted on."""
    return fitted_models(spark, sf_dir, [MO.LOGISTIC])["work"].train.select(S.INCIDENT_ID, S.LABEL)


@register(
    "fitted_predictions",
    _TRAIN_TEST_SQL + " SELECT m.model, incident_id, label, true AS has_score, true AS binary_prediction FROM kept,"
    " (VALUES ('" + "'), ('".join(MO.RECIPE) + "')) m(model) WHERE part = 'test'",
)
def q_fitted_predictions(spark, sf_dir):
    """Every test row under every classifier: it has a finite score and a 0/1
    prediction."""
    entry = fitted_models(spark, sf_dir)
    scored = MO.score_all(entry["fitted"], entry["work"].test, MO.RECIPE)
    score = F.col("score")
    return scored.select(
        "model",
        S.INCIDENT_ID,
        S.LABEL,
        F.coalesce(~F.isnan(score) & (F.abs(score) < F.lit(float("inf"))), F.lit(False)).alias("has_score"),
        F.coalesce(F.col("prediction").isin(0.0, 1.0), F.lit(False)).alias("binary_prediction"),
    )


@register(
    "importance_facts",
    "SELECT 'features' AS fact, 4::BIGINT AS value UNION ALL SELECT 'sum_is_one', 1 UNION ALL SELECT 'descending', 1 UNION ALL SELECT 'negative', 0",
)
def q_importance_facts(spark, sf_dir):
    """What holds for any forest's importances: one per feature, none
    negative, of sum one, reported in descending order."""
    entry = fitted_models(spark, sf_dir, [MO.FOREST])
    table = R.importance_table(spark, MO.importances(entry["fitted"].models[MO.FOREST]))
    # one value per feature, in the report's order
    values = table.agg(F.collect_list("importance").alias("v"))
    facts = values.select(
        F.size("v").cast("long").alias("features"),
        (F.abs(F.aggregate("v", F.lit(0.0), lambda a, x: a + x) - 1) < 1e-9).cast("long").alias("sum_is_one"),
        (F.col("v") == F.sort_array("v", asc=False)).cast("long").alias("descending"),
        F.size(F.filter("v", lambda x: x < 0)).cast("long").alias("negative"),
    )
    return facts.unpivot([], ["features", "sum_is_one", "descending", "negative"], "fact", "value")


# The vectors of the model rows, as the indexers fitted on the train part make them.
_VECTORS_SQL = (
    _TRAIN_TEST_SQL
    + ", vec AS (SELECT incident_id, label, part, CAST(hour AS DOUBLE) AS x1, CAST(district AS DOUBLE) AS x2, kind_idx AS x3, domestic_idx AS x4"
    " FROM sp JOIN ik USING (kind) JOIN id USING (domestic_str))"
)
_XS = range(1, len(FE.FEATURE_ORDER) + 1)


def _each(text: str, sep: str = ", ") -> str:
    return sep.join(text.format(j=j) for j in _XS)


# The optimum of the logistic loss, by simultaneous one-dimensional Newton steps on
# the standardised vectors (0.01 is the learner's penalty): its coefficients are
# those that the fit has to reach.
_OPTIMUM_SQL = _VECTORS_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + f"""
, tr AS MATERIALIZED (SELECT {_each("x{j}")}, COUNT(*)::DOUBLE AS n, SUM(label)::DOUBLE AS ones FROM vec WHERE part = 'train' GROUP BY ALL)
, tot AS MATERIALIZED (SELECT COUNT(*)::DOUBLE AS total, {_each("AVG(x{j}) AS m{j}, STDDEV_SAMP(x{j}) AS s{j}")} FROM vec WHERE part = 'train')
, z AS MATERIALIZED (SELECT n / total AS n, ones / total AS ones, {_each("(x{j} - m{j}) / s{j} AS z{j}")} FROM tr, tot)
, it AS (
  SELECT 0 AS k, 0::DOUBLE AS a, {_each("0::DOUBLE AS b{j}")}
  UNION ALL
  SELECT k + 1, a - SUM(n * p - ones) / SUM(n * p * (1 - p)),
         {_each("b{j} - (SUM((n * p - ones) * z{j}) + 0.01::DOUBLE * b{j}) / (SUM(n * p * (1 - p) * z{j} * z{j}) + 0.01::DOUBLE)")}
  FROM (SELECT *, 1 / (1 + exp(-(a + {_each("b{j} * z{j}", " + ")}))) AS p FROM it, z WHERE k < 60) GROUP BY k, a, {_each("b{j}")}
)
, best AS MATERIALIZED (SELECT total, a - {_each("b{j} * m{j} / s{j}", " - ")} AS c0, {_each("b{j} / s{j} AS c{j}")} FROM it, tot WHERE k = 60)"""


@register(
    "logistic_optimum",
    _OPTIMUM_SQL
    + " SELECT t.term, best.total::BIGINT AS train_rows, round([c0, " + _each("c{j}") + "][t.i], 6) AS coefficient, true AS fit_is_there"
    " FROM best, (VALUES ('" + L.INTERCEPT + "', 1), " + ", ".join(f"('{n}', {i + 2})" for i, n in enumerate(FE.FEATURE_ORDER)) + ") t(term, i)",
)
def q_logistic_optimum(spark, sf_dir):
    """The optimum of the regularised loss over the training rows, and whether
    the fitted coefficients are there (per standardised feature)."""
    entry = fitted_models(spark, sf_dir, [MO.LOGISTIC])
    model = entry["fitted"].models[MO.LOGISTIC]
    rows = entry["work"].train.select(S.LABEL, vector_to_array(FE.FEATURES).alias(FE.FEATURES))
    fit = [*model.coefficients.toArray().tolist(), float(model.intercept)]
    best = L.optimum(rows, fit, model.getRegParam())
    names = [*FE.FEATURE_ORDER, L.INTERCEPT]
    scale = [*best.deviations.tolist(), 1.0]
    made = [(n, best.rows, float(c), bool(abs(c - f) * u < 1e-5)) for n, c, f, u in zip(names, best.coefficients, fit, scale, strict=True)]
    table = spark.createDataFrame(made, "term string, train_rows long, coefficient double, fit_is_there boolean")
    return table.withColumn("coefficient", F.round("coefficient", 6))


@register(
    "logistic_test_metrics",
    _OPTIMUM_SQL
    + f""", d AS (SELECT round(c0 + {_each("c{j} * x{j}", " + ")}, 7) AS s, SUM(label) AS pos, SUM(1 - label) AS neg FROM vec, best WHERE part = 'test' GROUP BY 1)
, r AS (SELECT *, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM d)
SELECT round(SUM(pos * (below + 0.5::DOUBLE * neg)) / (SUM(pos)::DOUBLE * SUM(neg)), 4) AS auc,
       SUM(CASE WHEN s > 0 THEN 0 ELSE neg END)::BIGINT AS tn, SUM(CASE WHEN s > 0 THEN neg ELSE 0 END)::BIGINT AS fp,
       SUM(CASE WHEN s > 0 THEN 0 ELSE pos END)::BIGINT AS fn, SUM(CASE WHEN s > 0 THEN pos ELSE 0 END)::BIGINT AS tp
FROM r""",
)
def q_logistic_test_metrics(spark, sf_dir):
    """AUC and confusion counts of the fitted logistic regression on the test
    part; SQL scores the same rows at the optimum of its own."""
    rec = M.metrics_record(fitted_scores(spark, sf_dir, [MO.LOGISTIC]), with_confusion=True)
    return rec.select(F.round("auc", 4).alias("auc"), "tn", "fp", "fn", "tp")


# All splits that the boosted model's first tree may choose from at its root: a
# threshold between two values of a number, or a prefix of a category's values in
# the order of their means. The first tree regresses the labels -1 and 1 on all
# training rows, so that SQL can find its best split.
_CONTINUOUS_CUTS = (
    "SELECT {j} AS f, t AS threshold, NULL::DOUBLE[] AS categories, v.n, v.s, v.x <= t AS l FROM"
    " (SELECT x{j} AS x, COUNT(*)::DOUBLE AS n, SUM(y) AS s FROM y GROUP BY 1) v,"
    " (SELECT (x + lead(x) OVER (ORDER BY x)) / 2 AS t FROM (SELECT DISTINCT x{j} AS x FROM y)) WHERE t IS NOT NULL"
)
_CATEGORY_CUTS = (
    "SELECT {j}, NULL, c.cats, v.n, v.s, list_contains(c.cats, v.x) FROM"
    " (SELECT x{j} AS x, COUNT(*)::DOUBLE AS n, SUM(y) AS s FROM y GROUP BY 1) v,"
    " (SELECT list(x) OVER (ORDER BY s / n, x) AS cats, row_number() OVER (ORDER BY s / n DESC, x DESC) AS last"
    " FROM (SELECT x{j} AS x, COUNT(*)::DOUBLE AS n, SUM(y) AS s FROM y GROUP BY 1)) c WHERE c.last > 1"
)
_FIRST_SPLIT_SQL = (
    _VECTORS_SQL
    + ", y AS MATERIALIZED (SELECT x1, x2, x3, x4, 2.0::DOUBLE * label - 1 AS y FROM vec WHERE part = 'train')"
    + ", whole AS (SELECT COUNT(*)::DOUBLE AS n, SUM(y) AS s FROM y), side AS ("
    + " UNION ALL ".join([_CONTINUOUS_CUTS.format(j=1), _CONTINUOUS_CUTS.format(j=2), _CATEGORY_CUTS.format(j=3), _CATEGORY_CUTS.format(j=4)])
    + "), cut AS (SELECT f, threshold, categories, SUM(n) FILTER (WHERE l) AS ln, SUM(s) FILTER (WHERE l) AS ls FROM side GROUP BY ALL)"
    ", gained AS (SELECT cut.*, whole.n, whole.s,"
    " (ls * ls / ln + (whole.s - ls) * (whole.s - ls) / (whole.n - ln) - whole.s * whole.s / whole.n) / whole.n AS gain FROM cut, whole)"
    " SELECT n::BIGINT AS n_rows, round(s / n, 9) AS prediction, round(1 - (s / n) * (s / n), 9) AS impurity, "
    + "['" + "', '".join(FE.FEATURE_ORDER) + "'][f] AS feature, threshold, array_to_string(list_sort(categories), ',') AS categories, round(gain, 9) AS gain,"
    " ln::BIGINT AS left_rows, round(ls / ln, 9) AS left_prediction, (n - ln)::BIGINT AS right_rows, round((s - ls) / (n - ln), 9) AS right_prediction"
    " FROM gained ORDER BY gained.gain DESC LIMIT 1"
)


@register("boosted_first_split", _FIRST_SPLIT_SQL)
def q_boosted_first_split(spark, sf_dir):
    """The root of the boosted model's first tree, from its node table."""
    split = T.split_report(fitted_nodes(spark, sf_dir, MO.BOOSTED), tree=0, node=0)
    shown = F.array_join(F.transform("categories", lambda x: x.cast("string")), ",").alias("categories")
    rounded = ("prediction", "impurity", "gain", "left_prediction", "right_prediction")
    return split.select(*[shown if c == "categories" else F.round(c, 9).alias(c) if c in rounded else F.col(c) for c in split.columns])


_TREE_MODELS = (MO.FOREST, MO.BOOSTED)


@register(
    "node_table_scores",
    _TRAIN_TEST_SQL
    + ", test AS (SELECT COUNT(*) AS n FROM kept WHERE part = 'test')"
    f" SELECT m.model, m.trees, n AS test_rows, n AS equal_predictions, n AS equal_scores, 2::BIGINT AS classes FROM test,"
    f" (VALUES ('{MO.FOREST}', 100::BIGINT), ('{MO.BOOSTED}', 50::BIGINT)) m(model, trees)",
)
def q_node_table_scores(spark, sf_dir):
    """Test rows scored level by level from the node tables of the fitted
    ensembles, next to the models' own scores and predictions. ``classes`` counts
    the different predictions, one for a model that has learnt nothing."""
    work = fitted_models(spark, sf_dir, _TREE_MODELS)["work"]
    vectors = work.test.select(S.INCIDENT_ID, vector_to_array(FE.FEATURES).alias(FE.FEATURES))
    out = None
    for name in _TREE_MODELS:
        model, nodes = fitted_models(spark, sf_dir, [name])["fitted"].models[name], fitted_nodes(spark, sf_dir, name)
        rows = fitted_scores(spark, sf_dir, [name]).join(vectors, S.INCIDENT_ID)
        scored = T.score_from_nodes(rows, nodes, T.ensemble_kind(model), model.getNumTrees, model.getOrDefault("maxDepth"))
        found = scored.agg(
            F.lit(name).alias("model"),
            F.lit(model.getNumTrees).cast("long").alias("trees"),
            F.count(F.lit(1)).alias("test_rows"),
            F.count_if(F.col("prediction") == F.col("table_prediction")).alias("equal_predictions"),
            F.count_if(F.abs(F.col("score") - F.col("table_score")) < 1e-9).alias("equal_scores"),
            (1 + (F.max("table_prediction") > F.min("table_prediction")).cast("long")).alias("classes"),
        )
        out = found if out is None else out.unionByName(found)
    return out


@register(
    "node_table_importances",
    "SELECT m.model, f.feature, true AS equal FROM (VALUES ('" + "'), ('".join(_TREE_MODELS) + "')) m(model), (VALUES ('"
    + "'), ('".join(FE.FEATURE_ORDER) + "')) f(feature)",
)
def q_node_table_importances(spark, sf_dir):
    """Importances summed from the node tables, next to the models' own; every
    feature is split on."""
    out = None
    for name in _TREE_MODELS:
        model, nodes = fitted_models(spark, sf_dir, [name])["fitted"].models[name], fitted_nodes(spark, sf_dir, name)
        own = F.create_map(*[x for f, v in MO.importances(model) for x in (F.lit(f), F.lit(v))])
        equal = F.abs(F.col("importance") - F.element_at(own, F.col("feature"))) < 1e-9
        found = T.importances_from_nodes(nodes, T.ensemble_kind(model)).select(F.lit(name).alias("model"), "feature", equal.alias("equal"))
        out = found if out is None else out.unionByName(found)
    return out


#: Metrics of a table of scored rows, in Spark SQL: another way than ``metrics``.
SCORES_SQL = """
WITH t AS (SELECT model, CAST(label AS DOUBLE) AS l, prediction AS p, score AS s FROM {scores}),
d AS (SELECT model, s, sum(l) AS pos, sum(1 - l) AS neg FROM t GROUP BY model, s),
r AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY s) - neg AS below FROM d),
a AS (SELECT model, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM r GROUP BY model),
c AS (SELECT model, k.c, sum(CASE WHEN l = k.c THEN 1D END) AS actual, sum(CASE WHEN p = k.c THEN 1D ELSE 0D END) AS chosen,
             sum(CASE WHEN l = k.c AND p = k.c THEN 1D ELSE 0D END) AS hit FROM (SELECT *, explode(array(0D, 1D)) AS c FROM t) k GROUP BY model, k.c),
w AS (SELECT model, sum(hit) / sum(actual) AS accuracy, sum(actual * 2 * hit / (actual + chosen)) / sum(actual) AS f1,
             sum(actual * coalesce(try_divide(hit, chosen), 0D)) / sum(actual) AS weighted_precision, sum(hit) / sum(actual) AS weighted_recall FROM c GROUP BY model)
SELECT * FROM a JOIN w USING (model)
"""


@register(
    "fitted_metrics_agree",
    "SELECT m.model, k.metric, true AS agrees, true AS better_than_constant FROM (VALUES ('" + "'), ('".join(MO.RECIPE) + "')) m(model), (VALUES ('"
    + "'), ('".join(M.METRIC_NAMES) + "')) k(metric)",
)
def q_fitted_metrics_agree(spark, sf_dir):
    """The metrics of every fitted model, recomputed in SQL from the stored
    scores; ``better_than_constant`` is an AUC above one half."""
    scores = fitted_scores(spark, sf_dir, MO.RECIPE)
    view = f"fitted_scores_{zlib.crc32(sf_dir.encode()):08x}"
    scores.createOrReplaceTempView(view)
    again = M.metrics_long(spark.sql(SCORES_SQL.format(scores=view))).withColumnRenamed("value", "again")
    own = M.metrics_record(scores, by=["model"])
    good = own.select("model", (F.col("auc") > 0.5).alias("better_than_constant"))
    both = M.metrics_long(own).join(again, ["model", "metric"]).join(good, "model")
    return both.select("model", "metric", (F.abs(F.col("value") - F.col("again")) < 1e-12).alias("agrees"), "better_than_constant")


@register("fit_logistic")
def q_fit_logistic(spark, sf_dir):
    return model_records(spark, sf_dir, [MO.LOGISTIC])


@register("fit_forest")
def q_fit_forest(spark, sf_dir):
    return model_records(spark, sf_dir, [MO.FOREST])


@register("fit_boosted")
def q_fit_boosted(spark, sf_dir):
    return model_records(spark, sf_dir, [MO.BOOSTED])


@register("model_scores")
def q_model_scores(spark, sf_dir):
    return model_records(spark, sf_dir, MO.RECIPE)


@register("model_report")
def q_model_report(spark, sf_dir):
    rec = model_records(spark, sf_dir, MO.RECIPE)
    return M.metrics_pivot(M.metrics_long(rec, metrics=(*M.METRIC_NAMES, "train_s")), MO.RECIPE)


@register("best_fitted_model")
def q_best_fitted_model(spark, sf_dir):
    return M.best_by(model_records(spark, sf_dir, MO.RECIPE), "auc").select("model", "auc")


@register("feature_importances")
def q_feature_importances(spark, sf_dir):
    entry = fitted_models(spark, sf_dir, [MO.FOREST])
    return R.importance_table(spark, MO.importances(entry["fitted"].models[MO.FOREST]))


# ------------------------------------------------------------------ reports


@register(
    "importance_bar",
    WITH_INCIDENTS
    + """, c AS (SELECT kind, COUNT(*) AS n FROM incidents GROUP BY kind)
          SELECT kind, CAST(n AS DOUBLE) / SUM(n) OVER () AS share,
                 repeat('#', CAST(round_even((CAST(n AS DOUBLE) / SUM(n) OVER ()) * 50.0::DOUBLE, 0) AS INTEGER)) AS bar
          FROM c""",
)
def q_importance_bar(spark, sf_dir):
    """Bars of one mark per 2% for each kind's share of all rows; the total
    is a scalar subquery over the per-kind counts."""
    counts = A.kind_counts(incidents_at(spark, sf_dir))
    total = counts.agg(F.sum(A.COUNT).alias("__total"))
    with_total = M.attach(counts, total, [])
    share = F.col(A.COUNT).cast("double") / F.col("__total").cast("double")
    return R.with_bar(with_total.select(S.KIND, share.alias("share")), "share")


@register(
    "reconcile_counts",
    WITH_INCIDENTS
    + f""", sp AS (SELECT place, {_PART_SQL} AS part FROM incidents),
          a AS (SELECT place, COUNT(*) AS n FROM sp WHERE part = 'train' GROUP BY place),
          b AS (SELECT place, COUNT(*) AS n FROM sp WHERE part = 'test' GROUP BY place)
          SELECT COALESCE(a.place, b.place) AS place, COALESCE(a.n, 0) AS train_rows,
                 COALESCE(b.n, 0) AS test_rows, COALESCE(a.n, 0) - COALESCE(b.n, 0) AS delta
          FROM a FULL OUTER JOIN b ON a.place IS NOT DISTINCT FROM b.place""",
)
def q_reconcile_counts(spark, sf_dir):
    train, test = SM.hash_parts(incidents_at(spark, sf_dir), S.INCIDENT_ID)
    a = A.counts_by(train, S.PLACE)
    b = A.counts_by(test, S.PLACE)
    return R.reconcile_counts(a, b, S.PLACE, A.COUNT, A.COUNT, "train_rows", "test_rows")


@register(
    "job_report",
    WITH_INCIDENTS
    + ", hot AS (SELECT COUNT(*) AS hits FROM incidents WHERE place IS NOT NULL GROUP BY place ORDER BY hits DESC, place LIMIT 10)"
    ", often AS (SELECT COUNT(*) AS n FROM incidents GROUP BY kind HAVING COUNT(*) >= 100)"
    f" SELECT 'profile' AS report, {len(_PROFILE_TYPES)}::BIGINT AS n_rows, (SELECT ("
    + " + ".join(f"COUNT({c})" for c, _ in _PROFILE_TYPES)
    + ") FROM incidents)::BIGINT AS total"
    " UNION ALL SELECT 'kind_counts', COUNT(DISTINCT kind) + MAX(CASE WHEN kind IS NULL THEN 1 ELSE 0 END), COUNT(*) FROM incidents"
    " UNION ALL SELECT 'place_hotspots', COUNT(*), SUM(hits)::BIGINT FROM hot"
    " UNION ALL SELECT 'year_counts', COUNT(DISTINCT year) + MAX(CASE WHEN year IS NULL THEN 1 ELSE 0 END), COUNT(*) FROM incidents"
    " UNION ALL SELECT 'overall_rate', 1, COUNT(*) FROM incidents"
    " UNION ALL SELECT 'arrest_rate_by_kind', COUNT(*), SUM(n)::BIGINT FROM often",
)
def q_job_report(spark, sf_dir):
    """The job's report part over the whole table: the tables it writes, read
    back, with their rows and the total of the rows they count."""
    out = shared_dir(spark, "job-report")
    counted = {"profile": "non_null", "place_hotspots": "hits"}
    made = None
    for name in J.write_reports(incidents_at(spark, sf_dir), out, min_rows=100):
        report = spark.read.parquet(f"{out}/{name}")
        row = report.agg(F.lit(name).alias("report"), F.count(F.lit(1)).alias("n_rows"), F.sum(counted.get(name, "n_rows")).cast("long").alias("total"))
        made = row if made is None else made.unionByName(row)
    return made
