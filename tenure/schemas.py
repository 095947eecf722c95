"""Declared shapes of the two source tables and the derived outputs.

The source database enforces keys, nullability and lengths; parquet tables do
not, so the declarations live here and the checks in
``tenure.operators.checks`` turn them into Spark jobs.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Table and column names, varchar lengths and keys as declared
# by the source schema. They must stay equal for outputs to line up.
EMPLOYEE_TABLE = "Employee"
HISTORY_TABLE = "PositionHistory"
DIM_EMPLOYEE_TABLE = "DimEmployee"
DIM_HISTORY_TABLE = "DimPositionHistory"
FACT_TABLE = "FactTrainingDays"

KEY = "EmployeeId"

EMPLOYEE = T.StructType(
    [
        T.StructField("Id", T.IntegerType(), False),
        T.StructField("EmployeeId", T.StringType(), False),
        T.StructField("FullName", T.StringType(), False),
        T.StructField("BirthDate", T.DateType(), False),
        T.StructField("Address", T.StringType(), True),
    ]
)

POSITION_HISTORY = T.StructType(
    [
        T.StructField("Id", T.IntegerType(), False),
        T.StructField("PosId", T.StringType(), False),
        T.StructField("PosTitle", T.StringType(), False),
        T.StructField("EmployeeId", T.StringType(), False),
        T.StructField("StartDate", T.DateType(), False),
        T.StructField("EndDate", T.DateType(), False),
    ]
)

VARCHAR_LIMITS = {
    EMPLOYEE_TABLE: {"EmployeeId": 10, "FullName": 100, "Address": 500},
    HISTORY_TABLE: {"PosId": 10, "PosTitle": 100, "EmployeeId": 10},
}

PRIMARY_KEYS = {EMPLOYEE_TABLE: ["Id"], HISTORY_TABLE: ["Id"]}
UNIQUE_KEYS = {EMPLOYEE_TABLE: [["EmployeeId"]], HISTORY_TABLE: []}


def not_null_columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields if not f.nullable]


# Employee attributes carried into the query outputs, in declared order.
EMPLOYEE_ATTRS = ["EmployeeId", "FullName", "BirthDate", "Address"]
# Position attributes carried into the query outputs, in declared order.
POSITION_ATTRS = ["PosId", "PosTitle"]

# Column order of the wide training history (as in the golden CSV header).
TRAINING_HISTORY_COLUMNS = [
    "Id_Employee",
    "EmployeeId",
    "FullName",
    "BirthDate",
    "Address",
    "Id_PositionHistory",
    "PosId",
    "PosTitle",
    "StartDate",
    "EndDate",
    "training_day_duration",
    "rn",
]
TRAINING_FACT_COLUMNS = ["Id_Employee", "Id_PositionHistory", "training_day_duration"]
TRAINING_PERIOD_COLUMNS = ["EmployeeId", "StartDate", "EndDate", "training_day_duration"]


def ddl(schema: T.StructType, limits: dict[str, int] | None = None) -> str:
    """Column list for ``CREATE TABLE``, with ``VARCHAR(n)`` where declared."""
    limits = limits or {}
    parts = []
    for f in schema.fields:
        typ = f"VARCHAR({limits[f.name]})" if f.name in limits else f.dataType.simpleString().upper()
        parts.append(f"{f.name} {typ}{'' if f.nullable else ' NOT NULL'}")
    return ", ".join(parts)


def present(columns: list[str], available: list[str]) -> list[str]:
    """Declared columns that a given frame actually carries, in declared order.

    Stand-in sources may lack an attribute (for instance a birth date); the
    queries then carry what exists instead of inventing values.
    """
    have = set(available)
    return [c for c in columns if c in have]
