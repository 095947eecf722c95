from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tenure import schemas as S  # noqa: E402
from tenure.session import build_session  # noqa: E402
from tenure.sources.tables import literal_rows  # noqa: E402


@pytest.fixture(scope="session")
def work_dir():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


@pytest.fixture(scope="session")
def spark(work_dir):
    s = build_session(
        "local[*]",
        app_name="tenure-tests",
        shuffle_partitions=8,
        extra={
            # Tests name their own shared folder; a cluster sets it for us.
            "spark.checkpoint.dir": f"{work_dir}/checkpoints",
            "spark.sql.warehouse.dir": f"{work_dir}/warehouse",
            "spark.driver.memory": "4g",
        },
    )
    yield s
    s.stop()


# The seed rows of the source script. Rows 1 and 5 of the
# position history start on 2022-06-01 in the script and on 2022-01-01 in the
# sheet the job actually read.
EMPLOYEE_ROWS = [
    (1, 10105001, "Ali Anton", "1982-08-19", "Jakarta Utara"),
    (2, 10105002, "Rara Siva", "1982-01-01", "Mandalika"),
    (3, 10105003, "Rini Aini", "1982-02-20", "Sumbawa Besar"),
    (4, 10105004, "Budi", "1982-02-22", "Mataram Kota"),
]

SCRIPT_HISTORY_ROWS = [
    (1, 5000, "IT Manager", "10105001", "2022-06-01", "2022-02-28"),
    (2, 5001, "IT Sr. Manager", "10105001", "2022-03-01", "2022-12-31"),
    (3, 5002, "Programmer Analyst", "10105002", "2022-01-01", "2022-02-28"),
    (4, 5003, "Sr. Programmer Analyst", "10105002", "2022-03-01", "2022-12-31"),
    (5, 5004, "IT Admin", "10105003", "2022-06-01", "2022-02-28"),
    (6, 5005, "IT Secretary", "10105003", "2022-03-01", "2022-12-31"),
]


def sheet_rows():
    rows = [list(r) for r in SCRIPT_HISTORY_ROWS]
    rows[0][4] = "2022-01-01"
    rows[4][4] = "2022-01-01"
    return [tuple(r) for r in rows]


@pytest.fixture(scope="session")
def employee(spark):
    return literal_rows(spark, S.EMPLOYEE, EMPLOYEE_ROWS)


@pytest.fixture(scope="session")
def script_history(spark):
    return literal_rows(spark, S.POSITION_HISTORY, SCRIPT_HISTORY_ROWS)


@pytest.fixture(scope="session")
def sheet_history(spark):
    return literal_rows(spark, S.POSITION_HISTORY, sheet_rows())


def rows(df, *cols):
    """Rows of ``df`` as sorted tuples (nulls sort first)."""
    data = [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
    return sorted(data, key=lambda t: tuple((v is not None, v) for v in t))
