"""Reading incident tables: CSV with a fixed column map, Parquet, and the
standardising projection that every entry point shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.columns import bool_from_text, hour_of_text, label_of
from blotter.sources import schema as S


def whole_number(text: Column, type_name: str) -> Column:
    """An integer from its text; "11.0", as float exports write integers, is
    11, and text that is no whole number is NULL."""
    plain = text.try_cast(type_name)
    decimal = text.try_cast("decimal(38, 10)")
    return F.coalesce(plain, F.when(decimal == F.floor(decimal), F.floor(decimal).try_cast(type_name)))


def read_incident_csv(
    spark: SparkSession,
    path: str,
    header_names: Mapping[str, str] = S.CSV_HEADER_NAMES,
    infer_schema: bool = False,
) -> DataFrame:
    """Scan an incident CSV and return the raw canonical columns.

    By default every column is read as text and typed afterwards with
    ``try_cast``: no inference pass over the file, a single odd token
    ('Unknown' in a boolean column) becomes NULL in that cell instead of
    turning the whole column into text, and only the mapped columns are
    parsed (CSV column pruning). Quoted fields may hold commas. Columns of
    ``header_names`` absent from the file come back as NULL.
    """
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", infer_schema)
        .option("mode", "PERMISSIVE")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", False)
        # every file of a folder must have the first one's header
        .option("enforceSchema", False)
        .csv(path)
    )
    # Header names match case-insensitively and ignoring outer blanks.
    present = {c.strip().lower(): c for c in raw.columns}
    by_name = {canon: src for src, canon in header_names.items()}

    def pick(canon: str, type_name: str):
        src = by_name.get(canon)
        actual = present.get(src.strip().lower()) if src is not None else None
        if actual is None:
            return F.lit(None).cast(type_name).alias(canon)
        c = F.col(f"`{actual}`")
        if type_name == "boolean":
            c = bool_from_text(c.cast("string"))
        elif type_name != "string":
            c = whole_number(F.trim(c.cast("string")), type_name)
        return c.alias(canon)

    return raw.select(
        pick(S.INCIDENT_ID, "bigint"),
        pick(S.OCCURRED_TEXT, "string"),
        pick(S.KIND, "string"),
        pick(S.PLACE, "string"),
        pick(S.ARREST, "boolean"),
        pick(S.DOMESTIC, "boolean"),
        pick(S.DISTRICT, "int"),
        pick(S.YEAR, "int"),
    )


def write_incident_csv(df: DataFrame, path: str) -> None:
    """Write raw incident rows as CSV with the source header names."""
    to_header = {canon: src for src, canon in S.CSV_HEADER_NAMES.items()}
    out = df.select(*[F.col(c).alias(to_header[c]) for c in df.columns if c in to_header])
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def standardise(raw: DataFrame) -> DataFrame:
    """Add ``hour`` (parsed from the text timestamp), ``label`` (0/1 of the
    arrest flag) and ``domestic_str`` ("true"/"false") in one projection."""
    S.require_columns(raw, [S.OCCURRED_TEXT, S.ARREST, S.DOMESTIC])
    return raw.withColumns(
        {
            S.HOUR: hour_of_text(S.OCCURRED_TEXT),
            S.LABEL: label_of(S.ARREST),
            S.DOMESTIC_STR: F.col(S.DOMESTIC).cast("string"),
        }
    )


def profile(df: DataFrame) -> DataFrame:
    """The schema as rows (position, name, type, nullable) with the row
    count and each column's non-null count, from a single aggregation pass
    (no per-column job)."""
    fields = S.schema_rows(df)
    aggs = [F.count(F.lit(1)).alias("__rows")] + [
        F.count(F.col(f"`{name}`")).alias(f"__nn{i}") for i, (name, _, _) in enumerate(fields)
    ]
    stacked = ", ".join(
        f"{i}, '{name}', '{dtype}', {str(nullable).lower()}, __nn{i}"
        for i, (name, dtype, nullable) in enumerate(fields)
    )
    return df.agg(*aggs).selectExpr(
        "__rows AS n_rows",
        f"stack({len(fields)}, {stacked}) AS (position, column_name, data_type, nullable, non_null)",
    ).select(
        F.col("position").cast("int").alias("position"),
        "column_name",
        "data_type",
        "nullable",
        "n_rows",
        "non_null",
    )
