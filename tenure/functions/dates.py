"""Date helpers: the ``as_of`` day, parsing, and whole days between two values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


MICROS_PER_DAY = 86_400_000_000


def as_of_date(value: str | dt.date | None = None) -> Column:
    """The reference day for point-in-time questions.

    ``None`` means today in the session time zone (``current_date()``, fixed
    once per query); a string or ``date`` pins the day, which is what repeatable
    runs and tests should pass.
    """
    if value is None:
        return F.current_date()
    if isinstance(value, dt.datetime):
        value = value.date()
    if isinstance(value, dt.date):
        return F.lit(value)
    return F.to_date(F.lit(value))


def parse_date(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    """Column ``name`` as a date or timestamp.

    Strings are parsed with ``to_date`` (ANSI mode raises on text that is not a
    date, as the source job did); dates and timestamps pass through, so a time
    of day is kept and whole days are then floored, not truncated per side.
    """
    typ = df.schema[name].dataType
    c = F.col(name)
    if isinstance(typ, T.StringType):
        return (F.to_date(c, fmt) if fmt else F.to_date(c)).alias(name)
    if isinstance(typ, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c
    raise TypeError(f"{name}: cannot read {typ.simpleString()} as a date")


def whole_days(df: DataFrame, start: str, end: str) -> Column:
    """Whole days from ``start`` to ``end``; the end day itself is not counted.

    On dates this is ``datediff``. With a time of day on either side the
    elapsed time is floored to days, to the microsecond: 22 hours backwards is
    -1, not 0.
    Inverted intervals give negative values; nulls give null.
    """
    types = {df.schema[start].dataType, df.schema[end].dataType}
    if types <= {T.DateType()}:
        return F.datediff(F.col(end), F.col(start))
    if types <= {T.DateType(), T.TimestampNTZType()}:
        # Wall-clock values: no time zone, so no daylight-saving hour sneaks in.
        micros = F.timestamp_diff("MICROSECOND", F.col(start).cast("timestamp_ntz"), F.col(end).cast("timestamp_ntz"))
    else:
        micros = F.unix_micros(F.col(end).cast("timestamp")) - F.unix_micros(F.col(start).cast("timestamp"))
    # whole numbers throughout: a double would round long intervals
    return F.call_function("div", micros - F.pmod(micros, F.lit(MICROS_PER_DAY)), F.lit(MICROS_PER_DAY)).cast("int")
