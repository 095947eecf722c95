"""Constraint checks return what violates the declared schema."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from conftest import SCRIPT_HISTORY_ROWS, rows
from tenure import schemas as S
from tenure.operators.checks import duplicate_keys, length_violations, null_counts
from tenure.sources.tables import create_tables, insert_rows, literal_rows

NULLABLE_HISTORY = T.StructType([T.StructField(f.name, f.dataType, True) for f in S.POSITION_HISTORY.fields])


def test_keys_hold_on_seed_rows(employee, script_history):
    assert duplicate_keys(employee, ["Id"]).count() == 0
    assert duplicate_keys(employee, ["EmployeeId"]).count() == 0
    assert duplicate_keys(script_history, ["Id"]).count() == 0


def test_duplicate_and_null_keys_are_reported(spark):
    bad = literal_rows(
        spark,
        NULLABLE_HISTORY,
        SCRIPT_HISTORY_ROWS + [(1, 5000, "Copy", "10105001", "2022-01-01", "2022-01-31"), (None, 1, "x", "e", None, None)],
    )
    assert rows(duplicate_keys(bad, ["Id"])) == [(None, 1), (1, 2)]
    assert rows(duplicate_keys(bad, ["Id"], allow_null=True)) == [(1, 2)]


def test_null_counts(spark):
    df = literal_rows(spark, NULLABLE_HISTORY, SCRIPT_HISTORY_ROWS + [(9, 1, "t", None, "2022-01-01", None)])
    got = null_counts(df, S.not_null_columns(S.POSITION_HISTORY), "PositionHistory")
    assert got.columns == ["table_name", "column_name", "null_rows"]
    assert {r.column_name: r.null_rows for r in got.collect()} == {
        "Id": 0, "PosId": 0, "PosTitle": 0, "EmployeeId": 1, "StartDate": 0, "EndDate": 1,
    }


def test_length_violations(spark, employee):
    got = {r.column_name: (r.max_length, r.length_limit, r.too_long)
           for r in length_violations(employee, S.VARCHAR_LIMITS[S.EMPLOYEE_TABLE]).collect()}
    assert got == {"EmployeeId": (8, 10, 0), "FullName": (9, 100, 0), "Address": (13, 500, 0)}
    long_key = literal_rows(spark, S.EMPLOYEE, [(9, "12345678901", "X", "1980-01-01", None)])
    bad = {r.column_name: r.too_long for r in length_violations(long_key, S.VARCHAR_LIMITS[S.EMPLOYEE_TABLE]).collect()}
    assert bad["EmployeeId"] == 1


def test_varchar_tables_refuse_long_text(spark, work_dir):
    tables = create_tables(spark, "hr_checks", f"{work_dir}/hr_checks")
    insert_rows(spark, tables[0], S.EMPLOYEE, [(1, 10105001, "Ali Anton", "1982-08-19", "Jakarta Utara")])
    assert spark.table(tables[0]).count() == 1
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        insert_rows(spark, tables[0], S.EMPLOYEE, [(2, "12345678901", "Too Long Key", "1982-01-01", None)])
