"""Readers: typed tables, literal rows, JDBC extracts, sheet-backed CSV, catalog lists."""

from tenure.sources.jdbc import jdbc_options, read_jdbc, read_jdbc_partitioned
from tenure.sources.tables import (
    create_tables,
    insert_rows,
    literal_rows,
    read_warehouse_table,
    register_sheet_table,
)

__all__ = [
    "jdbc_options",
    "read_jdbc",
    "read_jdbc_partitioned",
    "create_tables",
    "insert_rows",
    "literal_rows",
    "read_warehouse_table",
    "register_sheet_table",
]
