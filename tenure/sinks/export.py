"""CSV export of a result, with an optional 0-based row index column."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tenure.plans.queries import CSV_ORDER, with_row_index
from tenure.sinks.replace import Written, replace_table

# Quotes inside a value are doubled, and blanks at its ends are part of it.
CSV_OPTIONS = {
    "header": "true",
    "dateFormat": "yyyy-MM-dd",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def export_csv(
    df: DataFrame,
    name: str,
    root: str,
    *,
    index_order: list[str] | None = CSV_ORDER,
    run_id: str | None = None,
    keep: int = 2,
) -> Written:
    """Write ``df`` as CSV with a header under ``<root>/<name>/version-<run>``.

    With ``index_order`` a ``row_index`` column (0-based, in that order) comes
    first, as a data-frame index would. The index, not the order of part
    files, defines row order (there is one file per task, never a single
    file). Nulls are written as empty fields.
    """
    if index_order:
        df = with_row_index(df, index_order)
    return replace_table(df, name, root, run_id=run_id, fmt="csv", options=CSV_OPTIONS, register=False, keep=keep)
