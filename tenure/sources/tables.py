"""Typed tables: creation, literal rows, warehouse scans, sheet-backed CSV.

Declared schemas are always passed to readers; nothing is inferred.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tenure import schemas as S


def create_tables(spark: SparkSession, database: str | None = None, location: str | None = None) -> list[str]:
    """``CREATE TABLE IF NOT EXISTS`` for Employee and PositionHistory.

    Text columns are ``VARCHAR(n)`` so an over-long insert fails as it would
    in the source database. Returns the qualified names.
    """
    prefix = f"{database}." if database else ""
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for table, schema in ((S.EMPLOYEE_TABLE, S.EMPLOYEE), (S.HISTORY_TABLE, S.POSITION_HISTORY)):
        loc = f" LOCATION '{location.rstrip('/')}/{table}'" if location else ""
        cols = S.ddl(schema, S.VARCHAR_LIMITS[table])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}{table} ({cols}) USING parquet{loc}")
        names.append(prefix + table)
    return names


def _coerce(value, field: T.StructField):
    """Literal values as the source database stores them on insert.

    Integers given for text columns become text (``10105001`` -> ``'10105001'``)
    and ISO strings for date columns become dates.
    """
    if value is None:
        return None
    if isinstance(field.dataType, T.StringType) and isinstance(value, int):
        return str(value)
    if isinstance(field.dataType, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    return value


def literal_rows(spark: SparkSession, schema: T.StructType, rows: Iterable[Sequence]) -> DataFrame:
    """A DataFrame from literal rows under a declared schema (``INSERT ... VALUES``).

    Explicit ids are kept as given. Meant for seed rows and fixtures; bulk
    data comes through the readers.
    """
    fields = schema.fields
    data = [tuple(_coerce(v, f) for v, f in zip(r, fields, strict=True)) for r in rows]
    return spark.createDataFrame(data, schema=schema, verifySchema=True)


def insert_rows(spark: SparkSession, table: str, schema: T.StructType, rows: Iterable[Sequence]) -> None:
    """Append literal rows to a created table (store assignment checks lengths)."""
    literal_rows(spark, schema, rows).write.insertInto(table)


def read_warehouse_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A warehouse table by catalog name, or a parquet folder by path.

    Catalyst prunes columns and pushes filters into either; ``SELECT *`` in
    the caller costs nothing extra.
    """
    if "/" in name_or_path or ":" in name_or_path:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(name_or_path)
    return spark.table(name_or_path)


def register_sheet_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """An external CSV table with a declared schema, re-read on every query.

    This is how a spreadsheet export sits behind a warehouse table: no copy,
    the files are the table. Rows that do not fit the schema fail the read
    (``FAILFAST``), as a bad date did in the source job.
    """
    cols = S.ddl(schema)
    if spark.catalog.tableExists(name):
        info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        if (info.get("Provider") or "").lower() != "csv" or info.get("Type") != "EXTERNAL":
            raise ValueError(f"{name} exists and is not an external CSV table; not replacing it")
        spark.sql(f"DROP TABLE {name}")  # external: only the definition goes
    spark.sql(
        f"CREATE TABLE {name} ({cols}) USING csv "
        f"OPTIONS (path '{path}', header '{str(header).lower()}', mode 'FAILFAST', dateFormat '{date_format}', "
        "escape '\"', ignoreLeadingWhiteSpace 'false', ignoreTrailingWhiteSpace 'false')"
    )
    return spark.table(name)
