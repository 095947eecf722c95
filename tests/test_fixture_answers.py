"""Expected answers on the literal seed rows (both history variants)."""

from __future__ import annotations

import datetime as dt

import pytest

from conftest import rows
from tenure.plans import queries as Q


@pytest.mark.parametrize(
    "variant,as_of,expected",
    [
        ("script", "2022-02-28", [("10105002", "Programmer Analyst")]),
        (
            "sheet",
            "2022-02-28",
            [("10105001", "IT Manager"), ("10105002", "Programmer Analyst"), ("10105003", "IT Admin")],
        ),
        (
            "script",
            "2022-03-01",
            [("10105001", "IT Sr. Manager"), ("10105002", "Sr. Programmer Analyst"), ("10105003", "IT Secretary")],
        ),
        (
            "sheet",
            "2022-06-15",
            [("10105001", "IT Sr. Manager"), ("10105002", "Sr. Programmer Analyst"), ("10105003", "IT Secretary")],
        ),
        ("script", "2024-04-03", []),
        ("sheet", "2024-04-03", []),
    ],
)
def test_current_position(request, employee, variant, as_of, expected):
    hist = request.getfixturevalue(f"{variant}_history")
    got = Q.current_position(employee, hist, as_of)
    assert got.columns == [
        "EmployeeId", "FullName", "BirthDate", "Address", "PosId", "PosTitle", "PhEmployeeId", "StartDate", "EndDate",
    ]
    assert rows(got, "EmployeeId", "PosTitle") == expected


def test_current_position_accepts_date_and_today(employee, sheet_history):
    assert Q.current_position(employee, sheet_history, dt.date(2022, 2, 28)).count() == 3
    # All positions ended in 2022, so "today" finds none.
    assert Q.current_position(employee, sheet_history).count() == 0


@pytest.mark.parametrize(
    "variant,expected",
    [
        ("script", [("10105001", "IT Manager"), ("10105002", "Sr. Programmer Analyst"), ("10105003", "IT Admin"), ("10105004", None)]),
        ("sheet", [("10105001", "IT Sr. Manager"), ("10105002", "Sr. Programmer Analyst"), ("10105003", "IT Secretary"), ("10105004", None)]),
    ],
)
@pytest.mark.parametrize("literal", [False, True])
def test_latest_position(request, employee, variant, expected, literal):
    hist = request.getfixturevalue(f"{variant}_history")
    got = Q.latest_position(employee, hist, literal=literal)
    assert got.columns == [
        "EmployeeId", "FullName", "BirthDate", "Address", "PosId", "PosTitle", "PhEmployeeId", "StartDate", "EndDate",
    ]
    assert rows(got, "EmployeeId", "PosTitle") == expected


@pytest.mark.parametrize(
    "variant,expected",
    [
        ("script", [(1, 2, 305), (2, 3, 58), (3, 6, 305)]),
        ("sheet", [(1, 1, 58), (2, 3, 58), (3, 5, 58)]),
    ],
)
def test_training_fact(request, employee, variant, expected):
    hist = request.getfixturevalue(f"{variant}_history")
    got = Q.training_fact(employee, hist)
    assert got.columns == ["Id_Employee", "Id_PositionHistory", "training_day_duration"]
    assert rows(got) == expected


def test_training_periods(employee, sheet_history):
    got = Q.training_periods(employee, sheet_history)
    assert got.columns == ["EmployeeId", "StartDate", "EndDate", "training_day_duration"]
    d = dt.date
    assert rows(got) == [
        ("10105001", d(2022, 1, 1), d(2022, 2, 28), 58),
        ("10105002", d(2022, 1, 1), d(2022, 2, 28), 58),
        ("10105003", d(2022, 1, 1), d(2022, 2, 28), 58),
    ]


# The golden CSV the source job wrote from the sheet variant.
GOLDEN_CSV = """\
,Id_Employee,EmployeeId,FullName,BirthDate,Address,Id_PositionHistory,PosId,PosTitle,StartDate,EndDate,training_day_duration,rn
0,1,10105001,Ali Anton,1982-08-19,Jakarta Utara,1,5000,IT Manager,2022-01-01,2022-02-28,58.0,1.0
1,1,10105001,Ali Anton,1982-08-19,Jakarta Utara,2,5001,IT Sr. Manager,2022-03-01,2022-12-31,305.0,2.0
2,2,10105002,Rara Siva,1982-01-01,Mandalika,3,5002,Programmer Analyst,2022-01-01,2022-02-28,58.0,1.0
3,2,10105002,Rara Siva,1982-01-01,Mandalika,4,5003,Sr. Programmer Analyst,2022-03-01,2022-12-31,305.0,2.0
4,3,10105003,Rini Aini,1982-02-20,Sumbawa Besar,5,5004,IT Admin,2022-01-01,2022-02-28,58.0,1.0
5,3,10105003,Rini Aini,1982-02-20,Sumbawa Besar,6,5005,IT Secretary,2022-03-01,2022-12-31,305.0,2.0
6,4,10105004,Budi,1982-02-22,Mataram Kota,,,,,,,
"""


def test_training_history_matches_golden(employee, sheet_history):
    wide = Q.training_history(employee, sheet_history, golden=True)
    header = GOLDEN_CSV.splitlines()[0].split(",")[1:]
    assert wide.columns == header
    indexed = Q.with_row_index(wide)
    got = sorted(indexed.collect(), key=lambda r: r["row_index"])

    def text(v):
        return "" if v is None else str(v)

    lines = [",".join(text(v) for v in r) for r in got]
    assert lines == GOLDEN_CSV.splitlines()[1:]


def test_csv_export_matches_golden(spark, employee, sheet_history, work_dir):
    from tenure.sinks.export import export_csv

    wide = Q.training_history(employee, sheet_history, golden=True)
    written = export_csv(wide, "historical_training_data", f"{work_dir}/golden")
    assert written.rows == 7
    text = spark.read.text(written.path).collect()
    header = [r.value for r in text if r.value.startswith("row_index,")]
    body = sorted((r.value for r in text if not r.value.startswith("row_index,")), key=lambda s: int(s.split(",")[0]))
    assert set(header) == {"row_index" + GOLDEN_CSV.splitlines()[0]}
    assert body == GOLDEN_CSV.splitlines()[1:]
