"""Physical plans: pushdown, join shape, exchanges, no whole-data single partition."""

from __future__ import annotations

import contextlib
import io

import pytest

from tenure.plans import queries as Q
from tenure.plans.standins import employee_standin, history_standin

SF = "/root/testdata/sf0.001"


def plan_text(df, mode: str = "simple") -> str:
    """``explain`` text: "simple" for the operator tree, "formatted" for untruncated scan details."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.fixture(scope="module")
def tables(spark, work_dir):
    """Stand-ins written as plain parquet tables, as a deployment would hold them."""
    base = f"{work_dir}/plan-tables"
    employee_standin(spark, SF).write.mode("overwrite").parquet(f"{base}/emp")
    history_standin(spark, SF).write.mode("overwrite").parquet(f"{base}/hist")
    return spark.read.parquet(f"{base}/emp"), spark.read.parquet(f"{base}/hist")


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_current_position_pushes_interval_and_joins_inner(tables, no_broadcast):
    emp, hist = tables
    plan = plan_text(Q.current_position(emp, hist, "1998-06-15"), "formatted")
    assert "LessThanOrEqual(StartDate,1998-06-15)" in plan
    assert "GreaterThanOrEqual(EndDate,1998-06-15)" in plan
    assert "LeftOuter" not in plan and "Inner" in plan
    # Only the columns the answer needs are read from the history.
    assert "ReadSchema: struct<PosTitle:string,EmployeeId:string,StartDate:date,EndDate:date>" in plan


def test_latest_and_fact_use_partial_aggregates_not_windows(tables, no_broadcast):
    emp, hist = tables
    for df in (Q.latest_position(emp, hist), Q.training_fact(emp, hist), Q.latest_position(emp, hist, literal=True)):
        plan = plan_text(df)
        assert "Window" not in plan
        assert "partial_max_by" in plan or "partial_min_by" in plan


def test_training_history_one_exchange_per_side(tables, no_broadcast):
    emp, hist = tables
    plan = plan_text(Q.training_history(emp, hist))
    assert plan.count("Exchange hashpartitioning(_k") == 2
    assert "SortMergeJoin" in plan and "LeftOuter" in plan
    assert "SinglePartition" not in plan


def test_small_dimension_is_broadcast_by_size(tables):
    emp, hist = tables
    plan = plan_text(Q.training_history(emp, hist))
    assert "BroadcastHashJoin" in plan


def test_row_index_has_no_whole_data_single_partition(tables):
    emp, hist = tables
    df = Q.with_row_index(Q.training_history(emp, hist))
    plan = plan_text(df)
    # Only the per-partition counts (at most one row per range partition) meet
    # in one partition; the rows themselves are joined to broadcast offsets.
    single = plan.split("Exchange SinglePartition")
    assert len(single) == 2
    assert "HashAggregate(keys=[_part" in single[1]
    assert "BroadcastHashJoin" in plan


def test_hot_keys_leave_the_window_and_join_broadcast_sides(tables, no_broadcast):
    emp, hist = tables
    plan = plan_text(Q.training_history(emp, hist, min_hot_rows=2))
    normal, hot = plan.split("Union", 1)[1].split("\n   +- ", 1)
    # Lines of the union's first child (nested cached-plan dumps are indented without ":").
    first_child = "\n".join(line for line in normal.splitlines() if line.startswith("   :"))
    # Normal keys: hot keys removed by a broadcast anti join, window, one exchange per side.
    assert "LeftAnti" in first_child and "Window" in first_child
    assert first_child.count("Exchange hashpartitioning(_k") == 2
    # Hot keys: no window; joined to broadcast offsets and broadcast employees.
    assert "Window [row_number()" not in hot
    assert "BroadcastHashJoin [_part" in hot
    assert hot.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in hot.split("InMemoryRelation")[0]


def test_bucketed_tables_need_no_shuffle(spark, work_dir, no_broadcast):
    from tenure.sinks.replace import replace_table

    root = f"{work_dir}/bucketed"
    emp, hist = employee_standin(spark, SF), history_standin(spark, SF)
    for _ in range(2):  # the second run repoints the existing bucketed tables
        replace_table(emp, "emp_b", root, bucket_by=(8, ["EmployeeId"]))
        replace_table(hist, "hist_b", root, bucket_by=(8, ["EmployeeId"]))
    e, h = spark.table("emp_b"), spark.table("hist_b")
    assert e.count() == emp.count() and h.count() == hist.count()
    for df in (Q.training_history(e, h), Q.latest_position(e, h), Q.training_fact(e, h)):
        plan = plan_text(df)
        assert "Bucketed: true" in plan
        assert "Exchange" not in plan
    assert sorted(Q.training_history(e, h).collect()) == sorted(Q.training_history(emp, hist).collect())


def test_indexed_history_adds_no_exchange_over_wide_rows(tables, no_broadcast):
    emp, hist = tables
    plan = plan_text(Q.training_history(emp, hist, row_index=True))
    # Same two key exchanges as the plain wide history; the index rides on the
    # employee side (offsets from the employee table only).
    assert plan.count("Exchange hashpartitioning(_k") == 2
    assert "rangepartitioning" not in plan.lower()
