"""Column names, source schema and schema guards for incident tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Canonical column names used throughout the library.
INCIDENT_ID = "incident_id"
OCCURRED_TEXT = "occurred_text"
KIND = "kind"
PLACE = "place"
HOUR = "hour"
DISTRICT = "district"
YEAR = "year"
DOMESTIC = "domestic"
ARREST = "arrest"
LABEL = "label"
DOMESTIC_STR = "domestic_str"

# Header names of the city incident CSV for the columns the
# analyses use, mapped to our canonical names.
CSV_HEADER_NAMES = {
    "ID": INCIDENT_ID,
    "Date": OCCURRED_TEXT,
    "Primary Type": KIND,
    "Location Description": PLACE,
    "Arrest": ARREST,
    "Domestic": DOMESTIC,
    "District": DISTRICT,
    "Year": YEAR,
}

# Raw incident columns after ingest, before standardisation.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(INCIDENT_ID, T.LongType(), True),
        T.StructField(OCCURRED_TEXT, T.StringType(), True),
        T.StructField(KIND, T.StringType(), True),
        T.StructField(PLACE, T.StringType(), True),
        T.StructField(ARREST, T.BooleanType(), True),
        T.StructField(DOMESTIC, T.BooleanType(), True),
        T.StructField(DISTRICT, T.IntegerType(), True),
        T.StructField(YEAR, T.IntegerType(), True),
    ]
)

# Columns the model needs; a row missing any of them cannot be assembled
# into a feature vector (the assembler rejects a null numeric input).
MODEL_INPUT_COLUMNS = (DISTRICT, KIND, HOUR, DOMESTIC_STR, LABEL)


def with_column_if_missing(df: DataFrame, name: str, make: Callable[[DataFrame], Column]) -> DataFrame:
    """Add ``name`` computed by ``make(df)`` only when the frame lacks it."""
    if name in df.columns:
        return df
    return df.withColumn(name, make(df))


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Fail early, with the missing names, instead of deep inside a plan."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def complete_rows(df: DataFrame, subset: Sequence[str] = MODEL_INPUT_COLUMNS) -> DataFrame:
    """Rows with a value in every column of ``subset`` (``dropna(how='any')``)."""
    require_columns(df, subset)
    return df.dropna(how="any", subset=list(subset))


def schema_rows(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) for every column: the schema as data."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
