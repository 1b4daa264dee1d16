"""The ``incidents`` view: incident records derived from the ``events`` table.

Every column is a deterministic function of one ``events`` row (no join, no
shuffle, no seed stream), so the view is a single narrow projection over the
Parquet scan and scales with ``events``. The same definition is given as
DuckDB SQL (``INCIDENTS_SQL``) for the oracle checks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.columns import TIMESTAMP_TEXT_FORMAT, clamp, hash_uniform, label_of
from blotter.sources import schema as S

# Arrest base rate per event type.
KIND_RATES = {
    "error": 0.85,
    "purchase": 0.60,
    "signup": 0.30,
    "view": 0.10,
    "click": 0.06,
}

# Place by user_id % 9, in order 0 to 8.
PLACES = [
    "STREET",
    "RESIDENCE",
    "APARTMENT",
    "SIDEWALK",
    "OTHER",
    "SCHOOL, PUBLIC, BUILDING",
    "PARKING LOT",
    "ALLEY",
    "RESIDENCE-GARAGE",
]

DOMESTIC_SHARE = 0.15
DOMESTIC_BUMP = 0.20
NIGHT_DIP = 0.10  # hours 2 to 5
RATE_FLOOR, RATE_CEIL = 0.01, 0.99
# Injected gaps: every 50th place, 97th district and 101st year is NULL.
PLACE_NULL_EVERY, DISTRICT_NULL_EVERY, YEAR_NULL_EVERY = 50, 97, 101
FIRST_YEAR, N_YEARS, N_DISTRICTS = 2020, 6, 25


def lookup(keys: Column, table: dict) -> Column:
    """CASE lookup of a small fixed table (a literal, codegen'd)."""
    expr = None
    for k, v in table.items():
        expr = F.when(keys == F.lit(k), F.lit(v)) if expr is None else expr.when(keys == F.lit(k), F.lit(v))
    return expr


def arrest_probability(rate: Column, domestic: Column, hour: Column) -> Column:
    """clamp(rate + bump if domestic - dip at hours 2-5), in double, in this
    order of operations (the DuckDB text uses the same order)."""
    bumped = rate + F.when(domestic, F.lit(DOMESTIC_BUMP)).otherwise(F.lit(0.0))
    dipped = bumped - F.when(hour.between(2, 5), F.lit(NIGHT_DIP)).otherwise(F.lit(0.0))
    return clamp(dipped, RATE_FLOOR, RATE_CEIL)


def raw_incidents(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Raw incident rows (text timestamp, booleans), as an ingest would give;
    ``keep`` names extra input columns to carry along."""
    eid = F.col("event_id")
    hour = F.hour("ts")
    domestic = hash_uniform(eid, "dom") < F.lit(DOMESTIC_SHARE)
    p = arrest_probability(lookup(F.col("event_type"), KIND_RATES), domestic, hour)
    place_of_user = F.element_at(F.array(*[F.lit(name) for name in PLACES]), (F.col("user_id") % 9 + 1).cast("int"))
    year = (F.lit(FIRST_YEAR) + F.floor(F.lit(float(N_YEARS)) * hash_uniform(eid, "year"))).cast("int")
    return events.select(
        eid.alias(S.INCIDENT_ID),
        F.date_format("ts", TIMESTAMP_TEXT_FORMAT).alias(S.OCCURRED_TEXT),
        F.col("event_type").alias(S.KIND),
        F.when(eid % PLACE_NULL_EVERY != 0, place_of_user).alias(S.PLACE),
        (hash_uniform(eid, "arrest") < p).alias(S.ARREST),
        domestic.alias(S.DOMESTIC),
        F.when(eid % DISTRICT_NULL_EVERY != 0, (F.col("user_id") % N_DISTRICTS + 1).cast("int")).alias(S.DISTRICT),
        F.when(eid % YEAR_NULL_EVERY != 0, year).alias(S.YEAR),
        *(keep or []),
    )


def incidents(events: DataFrame) -> DataFrame:
    """The ``incidents`` view: raw rows plus hour and label.

    The hour is taken from the timestamp itself; it equals the hour that
    ``standardise`` parses back from ``occurred_text`` (a test checks this),
    without formatting and parsing text for every row. Text ingest goes
    through ``standardise``."""
    raw = raw_incidents(events.withColumn("__hour", F.hour("ts").cast("int")), keep=["__hour"])
    return raw.select(
        S.INCIDENT_ID, S.OCCURRED_TEXT, S.KIND, S.PLACE, F.col("__hour").alias(S.HOUR),
        S.DISTRICT, S.YEAR, S.DOMESTIC, S.ARREST, label_of(S.ARREST).alias(S.LABEL),
    )


def duck_uniform(id_expr: str, salt: str) -> str:
    """DuckDB text of ``hash_uniform`` for an id expression."""
    return f"(('0x' || substr(md5(CAST({id_expr} AS VARCHAR) || ':{salt}'), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def _d(v: float) -> str:
    return f"{float(v)!r}::DOUBLE"


_PLACE_CASE = "CASE user_id % 9 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PLACES)) + " END"
_RATE_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN {_d(v)}" for k, v in KIND_RATES.items()) + " END"

# DuckDB text of the same view, used as a CTE by every oracle over incidents:
# ``WITH {INCIDENTS_SQL} SELECT ... FROM incidents``.
INCIDENTS_SQL = f"""incidents AS (
  SELECT incident_id, occurred_text, kind, place, hour, district, year,
         domestic, arrest, CAST(arrest AS INTEGER) AS label
  FROM (
    SELECT *,
           u_arrest < least({_d(RATE_CEIL)}, greatest({_d(RATE_FLOOR)},
               ({_RATE_CASE} + CASE WHEN domestic THEN {_d(DOMESTIC_BUMP)} ELSE 0.0::DOUBLE END)
               - CASE WHEN hour BETWEEN 2 AND 5 THEN {_d(NIGHT_DIP)} ELSE 0.0::DOUBLE END)) AS arrest
    FROM (
      SELECT event_id AS incident_id,
             strftime(ts, '%m/%d/%Y %I:%M:%S %p') AS occurred_text,
             event_type, event_type AS kind,
             CASE WHEN event_id % {PLACE_NULL_EVERY} = 0 THEN NULL ELSE {_PLACE_CASE} END AS place,
             CAST(hour(ts) AS INTEGER) AS hour,
             CASE WHEN event_id % {DISTRICT_NULL_EVERY} = 0 THEN NULL
                  ELSE CAST(user_id % {N_DISTRICTS} + 1 AS INTEGER) END AS district,
             CASE WHEN event_id % {YEAR_NULL_EVERY} = 0 THEN NULL
                  ELSE CAST({FIRST_YEAR} + floor({_d(N_YEARS)} * {duck_uniform('event_id', 'year')}) AS INTEGER) END AS year,
             {duck_uniform('event_id', 'dom')} < {_d(DOMESTIC_SHARE)} AS domestic,
             {duck_uniform('event_id', 'arrest')} AS u_arrest
      FROM events
    )
  )
)"""
