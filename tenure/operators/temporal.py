"""Validity intervals: which row holds on a given day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.functions.dates import as_of_date


def valid_at(
    history: DataFrame,
    as_of: str | dt.date | Column | None = None,
    start: str = "StartDate",
    end: str = "EndDate",
) -> DataFrame:
    """Rows whose closed interval [start, end] contains ``as_of``.

    Written as two plain comparisons on the stored columns so that the parquet
    reader receives them as pushed filters (row groups whose min/max cannot
    contain the day are skipped). Null bounds and inverted intervals never
    match, exactly like ``as_of BETWEEN start AND end``.
    """
    day = as_of if isinstance(as_of, Column) else as_of_date(as_of)
    return history.filter((F.col(start) <= day) & (F.col(end) >= day))
