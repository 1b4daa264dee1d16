"""Ingest edge cases: text timestamps, CSV quoting, odd tokens, empty cells,
header-only files, schema guards and the profile."""

import os

from pyspark.sql import functions as F

import pytest

from blotter.functions.columns import bool_from_text, hour_of_text
from blotter.sources import ingest as I
from blotter.sources import schema as S

CSV_TEXT = """ID,Case Number,Date,Primary Type,Location Description,Arrest,Domestic,District,Year
1,A1,01/02/2024 12:00:00 AM,THEFT,"SCHOOL, PUBLIC, BUILDING",TRUE,False,7,2024
2,A2,01/02/2024 12:00:00 PM,BATTERY,,false,true,,
3,A3,not a date,NARCOTICS,STREET,Unknown,FALSE,12,2023
4,A4,,THEFT,STREET,true,false,3,x
"""


def _write(tmp, text, name="in.csv"):
    path = os.path.join(tmp, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_hour_of_text_edges(spark):
    df = spark.createDataFrame(
        [("01/02/2024 12:00:07 AM",), ("01/02/2024 12:30:00 PM",), ("01/02/2024 11:59:59 PM",), ("bad",), ("",), (None,)],
        "t string",
    )
    got = [r[0] for r in df.select(hour_of_text("t")).collect()]
    assert got == [0, 12, 23, None, None, None]


def test_bool_from_text(spark):
    df = spark.createDataFrame([("TRUE",), ("False",), ("Unknown",), (None,), (" true ",)], "b string")
    assert [r[0] for r in df.select(bool_from_text("b")).collect()] == [True, False, None, None, True]


def test_csv_quoted_comma_nulls_and_odd_tokens(spark, tmp_shared):
    path = _write(tmp_shared, CSV_TEXT)
    raw = I.read_incident_csv(spark, path)
    assert raw.columns == [f.name for f in S.RAW_SCHEMA.fields]
    rows = {r[S.INCIDENT_ID]: r for r in I.standardise(raw).collect()}
    assert rows[1][S.PLACE] == "SCHOOL, PUBLIC, BUILDING"
    assert rows[1][S.HOUR] == 0 and rows[2][S.HOUR] == 12
    assert rows[1][S.ARREST] is True and rows[1][S.DOMESTIC] is False
    assert rows[1][S.DOMESTIC_STR] == "false"
    assert rows[2][S.PLACE] is None and rows[2][S.DISTRICT] is None and rows[2][S.YEAR] is None
    assert rows[3][S.ARREST] is None and rows[3][S.LABEL] is None and rows[3][S.HOUR] is None
    assert rows[4][S.HOUR] is None and rows[4][S.YEAR] is None and rows[4][S.DISTRICT] == 3


def test_csv_with_inferred_types_gives_same_rows(spark, tmp_shared):
    path = _write(tmp_shared, CSV_TEXT, "infer.csv")
    a = I.standardise(I.read_incident_csv(spark, path)).orderBy(S.INCIDENT_ID).collect()
    b = I.standardise(I.read_incident_csv(spark, path, infer_schema=True)).orderBy(S.INCIDENT_ID).collect()
    assert a == b


def test_shared_dir_uses_session_checkpoint_dir(spark):
    from blotter.session import ensure_checkpoint_dir, shared_dir

    base = ensure_checkpoint_dir(spark)
    d1, d2 = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert d1 != d2 and d1.startswith(base.rstrip("/"))


def test_csv_header_only(spark, tmp_shared):
    path = _write(tmp_shared, CSV_TEXT.splitlines()[0] + "\n", "empty.csv")
    assert I.standardise(I.read_incident_csv(spark, path)).count() == 0


def test_csv_missing_column_is_null(spark, tmp_shared):
    path = _write(tmp_shared, "Date,Primary Type,Arrest,Domestic\n01/02/2024 01:00:00 AM,THEFT,true,false\n", "few.csv")
    r = I.standardise(I.read_incident_csv(spark, path)).first()
    assert r[S.DISTRICT] is None and r[S.PLACE] is None and r[S.HOUR] == 1


def test_csv_header_case_and_blanks(spark, tmp_shared):
    path = _write(tmp_shared, "date, PRIMARY TYPE ,arrest,Domestic\n01/02/2024 03:00:00 PM,THEFT,FALSE,true\n", "case.csv")
    r = I.standardise(I.read_incident_csv(spark, path)).first()
    assert (r[S.KIND], r[S.HOUR], r[S.ARREST], r[S.DOMESTIC]) == ("THEFT", 15, False, True)


def test_csv_round_trip(spark, tmp_shared):
    from blotter.sources.incidents import raw_incidents

    raw = raw_incidents(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    out = os.path.join(tmp_shared, "rt")
    I.write_incident_csv(raw, out)
    back = I.read_incident_csv(spark, out)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_with_column_if_missing(spark):
    df = spark.createDataFrame([(True,)], "domestic boolean")
    added = S.with_column_if_missing(df, S.DOMESTIC_STR, lambda d: F.col(S.DOMESTIC).cast("string"))
    assert added.first()[S.DOMESTIC_STR] == "true"
    df2 = spark.createDataFrame([(True, "kept")], "domestic boolean, domestic_str string")
    kept = S.with_column_if_missing(df2, S.DOMESTIC_STR, lambda d: F.lit("new"))
    assert kept.first()[S.DOMESTIC_STR] == "kept"


def test_complete_rows_drops_any_null(spark):
    df = spark.createDataFrame(
        [(1, "A", 1, "true", 1), (None, "A", 1, "true", 1), (1, None, 1, "true", 1), (1, "A", 1, "true", None)],
        "district int, kind string, hour int, domestic_str string, label int",
    )
    assert S.complete_rows(df).count() == 1


def test_profile_counts(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType(), True)])
    df = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], schema)
    got = {r["column_name"]: (r["data_type"], r["nullable"], r["n_rows"], r["non_null"]) for r in I.profile(df).collect()}
    assert got == {"a": ("int", False, 3, 3), "b": ("string", True, 3, 2)}


def test_csv_decimal_text_of_integers(spark, tmp_shared):
    text = (
        "ID,Date,Primary Type,Arrest,Domestic,District,Year\n"
        "1,01/02/2024 01:00:00 AM,THEFT,true,false,11.0,2024.0\n"
        "2,01/02/2024 01:00:00 AM,THEFT,true,false,11.5,x\n"
    )
    rows = I.read_incident_csv(spark, _write(tmp_shared, text, "decimal.csv")).orderBy(S.INCIDENT_ID).collect()
    assert [(r[S.DISTRICT], r[S.YEAR]) for r in rows] == [(11, 2024), (None, None)]


def test_csv_files_of_one_folder_must_share_their_header(spark, tmp_shared):
    import os

    folder = os.path.join(tmp_shared, "mixed")
    os.makedirs(folder)
    _write(folder, "ID,Primary Type\n1,THEFT\n", "a.csv")
    _write(folder, "Primary Type,ID\nROBBERY,2\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        I.read_incident_csv(spark, folder).collect()
