"""One employee holding a third of all positions (derived from the supplied orders)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenure.operators.ranking import split_hot_groups
from tenure.plans import queries as Q
from tenure.plans.standins import employee_standin, read_table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def skewed(spark):
    """Every third order is moved to customer 1: one key with a third of the rows."""
    orders = read_table(spark, SF, "orders")
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit("1")).otherwise(F.col("o_custkey").cast("string"))
    hist = orders.select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderstatus").alias("PosId"),
        F.col("o_orderpriority").alias("PosTitle"),
        key.alias("EmployeeId"),
        F.col("o_orderdate").cast("date").alias("StartDate"),
        F.date_add(F.col("o_orderdate").cast("date"), 30).alias("EndDate"),
    )
    return employee_standin(spark, SF), hist


def test_hot_employee_is_split_out(spark, skewed):
    emp, hist = skewed
    n = hist.count()
    split = split_hot_groups(hist, ["EmployeeId"], n // 10)
    hot = {r.EmployeeId: r._rows for r in split.hot_keys.collect()}
    assert list(hot) == ["1"] and hot["1"] >= n // 3


def test_wide_history_with_hot_employee_equals_window(spark, skewed):
    emp, hist = skewed
    n = hist.count()
    plain = Q.training_history(emp, hist, min_hot_rows=0)  # 0: no split, one window
    split = Q.training_history(emp, hist, min_hot_rows=n // 10)
    assert split.count() == plain.count()
    assert split.exceptAll(plain).count() == 0 and plain.exceptAll(split).count() == 0
    ranks = split.filter("EmployeeId = '1'").agg(F.min("rn"), F.max("rn"), F.count("*")).first()
    assert (ranks[0], ranks[1]) == (1, ranks[2])  # 1..n without gaps or repeats


def test_top1_with_hot_employee(spark, skewed):
    emp, hist = skewed
    fact = Q.training_fact(emp, hist)
    wide = Q.training_history(emp, hist, min_hot_rows=0)
    want = wide.filter("rn = 1").select("Id_Employee", "Id_PositionHistory", "training_day_duration")
    assert fact.exceptAll(want).count() == 0 and want.exceptAll(fact).count() == 0


def test_sampled_screen_finds_exactly_the_hot_keys(spark, skewed):
    emp, hist = skewed
    hot_rows = hist.filter("EmployeeId = '1'").count()  # about a third of the rows
    # Sample fraction 1000 / (hot_rows * 0.8): the hot key is screened in, then counted exactly.
    split = split_hot_groups(hist, ["EmployeeId"], int(hot_rows * 0.8))
    assert {r.EmployeeId: r._rows for r in split.hot_keys.collect()} == {"1": hot_rows}
    # Above its true size it is a candidate but the exact count rejects it.
    assert split_hot_groups(hist, ["EmployeeId"], hot_rows + 1).hot_keys is None
