"""Edge rows: second unmatched employee, ties, nulls, inverted intervals, case, time of day."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import EMPLOYEE_ROWS, SCRIPT_HISTORY_ROWS, rows
from tenure import schemas as S
from tenure.functions.dates import whole_days
from tenure.functions.text import CASE_INSENSITIVE
from tenure.plans import queries as Q
from tenure.sources.tables import literal_rows

NULLABLE_HISTORY = T.StructType([T.StructField(f.name, f.dataType, True) for f in S.POSITION_HISTORY.fields])


@pytest.fixture(scope="module")
def emp2(spark):
    extra = [(5, 10105005, "Sari", "1985-05-05", None), (6, "abc01 ", "Case Key", "1990-01-01", "Bima")]
    return literal_rows(spark, S.EMPLOYEE, EMPLOYEE_ROWS + extra)


@pytest.fixture(scope="module")
def hist2(spark):
    extra = [
        # Tie on start for employee 2: the smaller Id ranks first, the larger is "latest".
        (7, 5006, "Analyst Tie A", "10105002", "2022-03-01", "2022-04-30"),
        (8, 5007, "Analyst Tie B", "10105002", "2022-03-01", "2022-05-31"),
        (9, 5008, "No Key", None, "2022-01-01", "2022-12-31"),
        (10, 5009, "No Start", "10105003", None, "2022-12-31"),
        (11, 5010, "No End", "10105003", "2021-01-01", None),
        (12, 5011, "Case Variant", "ABC01", "2022-01-01", "2022-12-31"),
    ]
    return literal_rows(spark, NULLABLE_HISTORY, SCRIPT_HISTORY_ROWS + extra)


def test_latest_keeps_every_employee_by_default(emp2, hist2):
    got = Q.latest_position(emp2, hist2)
    assert got.count() == 6
    assert rows(got, "EmployeeId", "PosTitle") == [
        ("10105001", "IT Manager"),
        ("10105002", "Analyst Tie B"),
        ("10105003", "IT Admin"),
        ("10105004", None),
        ("10105005", None),
        ("abc01 ", None),
    ]


def test_latest_literal_collapses_the_null_partition(emp2, hist2):
    got = Q.latest_position(emp2, hist2, literal=True)
    # Three employees without history share one partition; the smallest Id survives.
    assert rows(got, "EmployeeId", "PosTitle") == [
        ("10105001", "IT Manager"),
        ("10105002", "Analyst Tie B"),
        ("10105003", "IT Admin"),
        ("10105004", None),
    ]


def test_case_insensitive_keys(emp2, hist2):
    exact = Q.current_position(emp2, hist2, "2022-06-15")
    ci = Q.current_position(emp2, hist2, "2022-06-15", key_mode=CASE_INSENSITIVE)
    assert "ABC01" not in [r.PhEmployeeId for r in exact.collect()]
    matched = [(r.EmployeeId, r.PhEmployeeId) for r in ci.collect() if r.PosTitle == "Case Variant"]
    assert matched == [("abc01 ", "ABC01")]


def test_training_history_ranks_ties_and_nulls(emp2, hist2):
    got = Q.training_history(emp2, hist2)
    by_emp = {}
    for r in got.collect():
        by_emp.setdefault(r.EmployeeId, []).append((r.rn, r.Id_PositionHistory, r.training_day_duration))
    assert sorted(by_emp["10105002"]) == [(1, 3, 58), (2, 4, 305), (3, 7, 60), (4, 8, 91)]
    # Null start sorts last; null end gives a null duration; inverted interval is negative.
    assert sorted(by_emp["10105003"]) == [(1, 11, None), (2, 6, 305), (3, 5, -93), (4, 10, None)]
    assert by_emp["10105004"] == [(None, None, None)]
    # The null-key row never joins and is not numbered.
    assert 9 not in [r.Id_PositionHistory for r in got.collect()]


def test_fact_is_rn_one_of_history(emp2, hist2):
    wide = Q.training_history(emp2, hist2)
    from_wide = rows(wide.filter("rn = 1"), "Id_Employee", "Id_PositionHistory", "training_day_duration")
    assert rows(Q.training_fact(emp2, hist2)) == from_wide


def test_whole_days_floor_on_timestamps(spark):
    schema = T.StructType(
        [
            T.StructField("Id", T.IntegerType()),
            T.StructField("EmployeeId", T.StringType()),
            T.StructField("StartDate", T.TimestampType()),
            T.StructField("EndDate", T.TimestampType()),
        ]
    )
    hist = spark.createDataFrame(
        [(1, "e1", dt.datetime(2022, 1, 2, 23, 0), dt.datetime(2022, 1, 2, 1, 0)),
         (2, "e2", dt.datetime(2022, 1, 1, 6, 0), dt.datetime(2022, 1, 3, 5, 0))],
        schema,
    )
    emp = literal_rows(spark, S.EMPLOYEE, [(1, "e1", "A", "1980-01-01", None), (2, "e2", "B", "1980-01-01", None)])
    got = rows(Q.training_fact(emp, hist))
    assert got == [(1, 1, -1), (2, 2, 1)]


def test_text_dates_are_parsed_and_bad_dates_raise(spark):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ["Id", "EmployeeId", "StartDate", "EndDate"]])
    emp = literal_rows(spark, S.EMPLOYEE, [(1, "e1", "A", "1980-01-01", None)])
    good = spark.createDataFrame([("1", "e1", "2022-01-01", "2022-02-28")], schema)
    assert rows(Q.training_fact(emp, good), "training_day_duration") == [(58,)]
    bad = spark.createDataFrame([("1", "e1", "2022-01-01", "not a date")], schema)
    with pytest.raises(Exception):
        Q.training_fact(emp, bad).collect()


def test_whole_days_on_wall_clock_timestamps_ignore_dst(spark):

    df = spark.createDataFrame(
        [(dt.datetime(2022, 3, 12, 12, 0), dt.datetime(2022, 3, 14, 12, 0)),
         (dt.datetime(2022, 1, 2, 23, 0), dt.datetime(2022, 1, 2, 1, 0))],
        "s timestamp_ntz, e timestamp_ntz",
    )
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = [r.d for r in df.select(whole_days(df, "s", "e").alias("d")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [2, -1]


def test_empty_inputs(spark, employee, script_history):
    empty_emp = employee.limit(0)
    empty_hist = script_history.limit(0)
    for emp, hist, n_emp in ((empty_emp, script_history, 0), (employee, empty_hist, 4), (empty_emp, empty_hist, 0)):
        assert Q.current_position(emp, hist, "2022-06-15").count() == 0
        assert Q.latest_position(emp, hist).count() == n_emp
        assert Q.latest_position(emp, hist, literal=True).count() == (1 if n_emp else 0)
        wide = Q.training_history(emp, hist, row_index=True)
        assert sorted(r.row_index for r in wide.collect()) == list(range(n_emp))
        assert Q.training_fact(emp, hist).count() == 0 or hist is script_history


def test_row_index_with_case_insensitive_keys(emp2, hist2):
    fast = Q.training_history(emp2, hist2, key_mode=CASE_INSENSITIVE, row_index=True)
    general = Q.with_row_index(Q.training_history(emp2, hist2, key_mode=CASE_INSENSITIVE))
    assert fast.exceptAll(general).count() == 0 and general.exceptAll(fast).count() == 0
    case_rows = [r for r in fast.collect() if r.EmployeeId == "abc01 "]
    assert [r.PosTitle for r in case_rows] == ["Case Variant"]


def test_whole_days_keep_the_part_of_a_second(spark):
    rows = spark.sql(
        """select * from values
        (timestamp'2022-01-01 00:00:00.9', timestamp'2022-01-02 00:00:00.1', 0),
        (timestamp'2022-01-01 00:00:00.4', timestamp'2022-01-01 00:00:00.0', -1),
        (timestamp'2022-01-01 00:00:00', timestamp'2022-01-03 00:00:00', 2),
        (timestamp'1801-01-01 00:00:00', timestamp'2200-01-01 00:00:00', 145732) as t(a, b, days)"""
    )
    for kind in ("timestamp", "timestamp_ntz"):
        typed = rows.select(F.col("a").cast(kind), F.col("b").cast(kind), "days")
        assert typed.where(whole_days(typed, "a", "b") != F.col("days")).count() == 0
