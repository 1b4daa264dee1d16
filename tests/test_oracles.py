"""Every SQL-checkable query against its DuckDB oracle, plus the smoke entry."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_MID, SF_SMALL
from tests.oracle import compare, duck_connection

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_MID)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, tmp_path, name):
    problems, _ = compare(spark, duck, name, E.queries()[name], ORACLES[name], SF_MID, str(tmp_path))
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(ORACLES)))
def test_other_queries_can_be_written_and_read(spark, tmp_path, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.write.parquet(str(tmp_path / name))
    back = spark.read.parquet(str(tmp_path / name))
    assert back.columns == df.columns
    assert back.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["kind", "n_rows", "arrest_rate"]
    assert rows and all(r["n_rows"] >= 100 and 0 <= r["arrest_rate"] <= 1 for r in rows)


def test_queries_keep_nothing_in_memory(spark):
    """After the fits are released no query has left a persisted table."""
    from blotter.plans import catalog

    for name in ("auc_roc", "metrics_record", "kind_index", "model_test_rows"):
        catalog.QUERIES[name](spark, SF_SMALL).collect()
    catalog.release_fits()
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_building_a_metric_query_runs_no_job(spark):
    from blotter.plans import catalog

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "build only")
    catalog.QUERIES["metrics_record"](spark, SF_SMALL)
    catalog.QUERIES["auc_roc"](spark, SF_SMALL)
    assert list(tracker.getJobIdsForGroup("lazy")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
