"""Plan properties that the design relies on at scale, checked on the
physical plans of the registered queries: no cross products or nested-loop
joins, no Python UDF operators, pruned scans, partial aggregation, top-k
instead of a full sort, and no raw rows funnelled into a single task."""

import re

import pytest

import __spark_entry__ as E
from blotter.plans.catalog import ORACLES
from tests.conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_no_cross_joins_or_python_udfs(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    found = [op for op in FORBIDDEN if op in plan]
    assert not found, f"{name}: {found}"


def _read_schemas(plan: str) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", plan)


def test_kind_counts_reads_one_column_and_aggregates_partially(spark):
    plan = _plan(E.queries()["kind_counts"](spark, SF_SMALL))
    assert _read_schemas(plan) == ["struct<event_type:string>"]
    assert "partial_count" in plan


def test_hotspots_prune_columns_and_use_top_k(spark):
    for name in ("place_hotspots", "place_hotspots_sql"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert _read_schemas(plan) == ["struct<event_id:bigint,user_id:bigint>"]
        assert "TakeOrderedAndProject" in plan and "partial_count" in plan


def test_order_year_counts_reads_only_the_date(spark):
    plan = _plan(E.queries()["order_year_counts"](spark, SF_SMALL))
    assert _read_schemas(plan) == ["struct<o_orderdate:timestamp_ntz>"]


def test_overall_rate_is_one_pass(spark):
    plan = _plan(E.queries()["overall_arrest_rate"](spark, SF_SMALL))
    assert plan.count("FileScan") == 1


def test_hash_split_is_narrow(spark):
    """No exchange, and the scan reads the id alone."""
    for name in ("hash_split", "split_sizes"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert _read_schemas(plan) == ["struct<event_id:bigint>"], name
    assert "Exchange" not in _plan(E.queries()["hash_split"](spark, SF_SMALL))


def test_node_tables_are_joined_once_a_level(spark, monkeypatch):
    from blotter.operators import trees as T

    schema = "tree int, node int, left int, right int, feature_index int, categories array<double>, threshold double, stats array<double>, prediction double, tree_weight double"
    nodes = spark.createDataFrame([], schema)
    rows = spark.createDataFrame([], "id long, features array<double>")
    plan = _plan(T.leaf_of(rows, nodes, trees=10, depth=4))
    assert plan.count("Join") == 4 and "SortMergeJoin" not in plan
    monkeypatch.setattr(T, "BROADCAST_NODES", 5)
    assert "ResolvedHint" not in _plan(T.leaf_of(rows, nodes, trees=10, depth=4))


def test_weighted_metrics_have_no_join(spark):
    from blotter.operators import metrics as M
    from blotter.plans.catalog import incidents_at, scored_rows

    plan = _plan(M.weighted_metrics(scored_rows(incidents_at(spark, SF_SMALL)), with_confusion=True))
    assert "Join" not in plan and plan.count("FileScan") == 1


# A single-partition exchange may only carry a partial aggregate (one row per
# task) or the AUC's per-bucket table (at most ``buckets`` rows); raw rows
# must never be funnelled into one task.
_BOUNDED_CHILD = re.compile(r"functions=\[partial_|keys=\[__b#\d+\]")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_single_partition_exchanges_carry_bounded_rows(spark, name):
    lines = _plan(E.queries()[name](spark, SF_SMALL)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            child = lines[i + 1] if i + 1 < len(lines) else ""
            assert _BOUNDED_CHILD.search(child), f"{name}: {child.strip()[:120]}"


def test_auc_is_one_branch_over_a_range_exchange(spark):
    """The score axis is cut by a range exchange; nothing is read twice, joined
    back or searched row by row."""
    from blotter.operators import metrics as M
    from blotter.plans.catalog import incidents_at, scored_rows

    rows = scored_rows(incidents_at(spark, SF_SMALL))
    for df in (M.auc_roc(rows), M.metrics_record(rows), M.metrics_record(rows, by=["model"])):
        plan = _plan(df)
        assert plan.count("FileScan") == 1 and "rangepartitioning" in plan
        assert "Join" not in plan and "Subquery" not in plan and "lambdafunction" not in plan


def test_metric_counts_cells_before_expanding_them(spark):
    from blotter.operators import metrics as M
    from blotter.plans.catalog import incidents_at, scored_rows

    plan = _plan(M.weighted_metrics(scored_rows(incidents_at(spark, SF_SMALL))))
    assert plan.index("Generate") < plan.index("partial_count")


def test_random_split_reads_only_what_it_returns(spark):
    plan = _plan(E.queries()["random_split"](spark, SF_SMALL))
    assert all("user_id" not in x for x in _read_schemas(plan))
