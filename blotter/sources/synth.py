"""Synthetic incident rows drawn from an id table.

Each column is a hash uniform of (id, column salt), so the table is a narrow
projection over any id column: it partitions like its input, needs no driver
loop and gives the same rows for the same ids on any cluster, any partition
count and in DuckDB. One uniform decides the arrest and the label is its 0/1
cast, so the two always agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.functions.columns import hash_uniform
from blotter.sources import schema as S
from blotter.sources.incidents import arrest_probability, lookup

# Crime kinds and their base arrest rates, in this order.
SYNTH_KIND_RATES = {
    "NARCOTICS": 0.85,
    "PROSTITUTION": 0.80,
    "WEAPONS VIOLATION": 0.60,
    "BATTERY": 0.30,
    "ASSAULT": 0.25,
    "ROBBERY": 0.15,
    "THEFT": 0.10,
    "BURGLARY": 0.08,
    "MOTOR VEHICLE THEFT": 0.06,
    "CRIMINAL DAMAGE": 0.05,
}

# Location descriptions, in this order.
SYNTH_PLACES = [
    "STREET",
    "RESIDENCE",
    "APARTMENT",
    "SIDEWALK",
    "OTHER",
    "PARKING LOT",
    "SCHOOL",
    "ALLEY",
    "RESIDENCE-GARAGE",
]

# Years, number of districts and share of domestic incidents.
SYNTH_YEARS = [2020, 2021, 2022, 2023, 2024, 2025]
SYNTH_DISTRICTS = 25
SYNTH_DOMESTIC_SHARE = 0.15


def _pick(options: list, u) -> F.Column:
    idx = (F.floor(F.lit(float(len(options))) * u) + F.lit(1)).cast("int")
    return F.element_at(F.array(*[F.lit(o) for o in options]), idx)


def synthetic_incidents(ids: DataFrame, id_col: str) -> DataFrame:
    """One synthetic incident per row of ``ids``, keyed by ``id_col``."""
    i = F.col(id_col)
    kind = _pick(list(SYNTH_KIND_RATES), hash_uniform(i, "kind"))
    hour = F.floor(F.lit(24.0) * hash_uniform(i, "hour")).cast("int")
    domestic = hash_uniform(i, "dom") < F.lit(SYNTH_DOMESTIC_SHARE)
    staged = ids.select(
        i.alias(S.INCIDENT_ID),
        kind.alias(S.KIND),
        hour.alias(S.HOUR),
        domestic.alias(S.DOMESTIC),
        (F.floor(F.lit(float(SYNTH_DISTRICTS)) * hash_uniform(i, "district")) + F.lit(1)).cast("int").alias(S.DISTRICT),
        _pick(SYNTH_PLACES, hash_uniform(i, "place")).alias(S.PLACE),
        _pick(SYNTH_YEARS, hash_uniform(i, "year")).cast("int").alias(S.YEAR),
        hash_uniform(i, "arrest").alias("__u_arrest"),
    )
    p = arrest_probability(lookup(F.col(S.KIND), SYNTH_KIND_RATES), F.col(S.DOMESTIC), F.col(S.HOUR))
    arrest = F.col("__u_arrest") < p
    return staged.select(
        S.INCIDENT_ID,
        S.DISTRICT,
        S.KIND,
        S.PLACE,
        S.YEAR,
        S.HOUR,
        F.col(S.DOMESTIC).cast("string").alias(S.DOMESTIC_STR),
        arrest.alias(S.ARREST),
        arrest.cast("int").alias(S.LABEL),
    )
