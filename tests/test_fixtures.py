"""The derived incidents view against the numbers expected of it at sf0.01,
and analysis invariants."""

from pyspark.sql import functions as F

from blotter.operators import analytics as A
from blotter.operators import features as FE
from blotter.operators import sampling as SM
from blotter.plans.catalog import incidents_at, model_rows
from blotter.sources import schema as S
from tests.conftest import SF_MID

# Fixed expectations at sf0.01: kind -> (rows, label sum, hour sum, domestic sum).
EXPECTED = {
    "click": (2006, 155, 23203, 320),
    "error": (2014, 1727, 22879, 277),
    "purchase": (1981, 1231, 23274, 283),
    "signup": (2017, 665, 23060, 284),
    "view": (1982, 221, 22535, 307),
}


def test_incidents_per_kind(spark):
    inc = incidents_at(spark, SF_MID)
    got = {
        r["kind"]: (r["n"], r["labels"], r["hours"], r["dom"])
        for r in inc.groupBy("kind")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("label").alias("labels"),
            F.sum("hour").alias("hours"),
            F.sum(F.col("domestic").cast("int")).alias("dom"),
        )
        .collect()
    }
    assert got == EXPECTED


def test_view_hour_equals_parsed_text_hour(spark):
    from blotter.sources.incidents import raw_incidents
    from blotter.sources.ingest import standardise

    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    parsed = standardise(raw_incidents(ev)).select(S.INCIDENT_ID, S.HOUR, S.LABEL)
    view = incidents_at(spark, SF_MID).select(S.INCIDENT_ID, S.HOUR, S.LABEL)
    assert parsed.exceptAll(view).count() == 0 and view.exceptAll(parsed).count() == 0


def test_injected_nulls(spark):
    inc = incidents_at(spark, SF_MID)
    r = inc.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("place", "district", "year", "label")]).first()
    assert (r["place"], r["district"], r["year"], r["label"]) == (200, 104, 100, 0)


def test_hash_split_sizes(spark):
    sizes = {r["part"]: r["n_rows"] for r in SM.part_sizes(SM.hash_split(incidents_at(spark, SF_MID), S.INCIDENT_ID)).collect()}
    assert sizes == {"train": 7995, "test": 2005}


def test_kind_index_order(spark):
    # Over all rows (no drop-null): most frequent first.
    model = FE.fit_indexer(incidents_at(spark, SF_MID), [S.KIND], [FE.KIND_IDX])
    assert model.labelsArray[0] == ["signup", "error", "click", "view", "purchase"]
    # On the complete rows (NULL districts dropped) view and purchase swap.
    complete = FE.fit_indexer(model_rows(incidents_at(spark, SF_MID)), [S.KIND], [FE.KIND_IDX])
    assert complete.labelsArray[0][:3] == ["signup", "error", "click"]


def test_counts_sum_to_rows(spark):
    inc = incidents_at(spark, SF_MID)
    n = inc.count()
    for counts in (A.kind_counts(inc), A.year_counts(inc), A.counts_by(inc, S.PLACE)):
        assert counts.agg(F.sum(A.COUNT)).first()[0] == n


def test_year_counts_keep_null_group_first(spark):
    rows = A.year_counts(incidents_at(spark, SF_MID)).collect()
    assert rows[0]["year"] is None and rows[0][A.COUNT] == 100
    assert [r["year"] for r in rows[1:]] == list(range(2020, 2026))
    assert all(r["year"] is not None for r in A.drop_incomplete(A.year_counts(incidents_at(spark, SF_MID))).collect())


def test_ties_break_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "kind string")
    assert [r["kind"] for r in A.kind_counts(df).collect()] == ["c", "a", "b"]
    assert [r["kind"] for r in A.top_n(A.kind_counts(df), 2).collect()] == ["c", "a"]


def test_overall_rate_empty_input_is_null(spark):
    df = spark.createDataFrame([], "arrest boolean")
    r = A.overall_rate(df).first()
    assert r[A.COUNT] == 0 and r["arrest_rate"] is None and r["arrest_pct"] is None


def test_overall_rate_ignores_null_flags(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "arrest boolean")
    r = A.overall_rate(df).first()
    assert (r[A.COUNT], r["n_arrests"], r["arrest_pct"]) == (4, 2, 50.0)


def test_rate_by_min_support_and_null_labels(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("a", 0), ("b", 1)], "kind string, label int")
    rows = {r["kind"]: (r[A.COUNT], r["arrest_rate"]) for r in A.rate_by(df, "kind", min_rows=2).collect()}
    assert rows == {"a": (3, 0.5)}


def test_hotspots_sql_equals_dataframe_form(spark):
    inc = incidents_at(spark, SF_MID)
    view = A.register_view(inc, "t_hot")
    a = [tuple(r) for r in A.place_hotspots(inc, 5).collect()]
    b = [tuple(r) for r in A.place_hotspots_sql(spark, view, 5).collect()]
    assert a == b and len(a) == 5
