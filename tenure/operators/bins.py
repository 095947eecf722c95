"""Validity intervals stored by day bins, for lookups over a long history.

Start and end of an interval cannot both be sorted, so no order of files lets a
scan for one day skip most of a long history. Here each row is stored once in
every bin of ``width`` days that its closed interval touches, and bins are
partitions of the stored table:

* one day lies in one bin, so a lookup reads one partition and finds each row
  that holds on that day exactly once;
* a list of days joins on the bin, then compares dates;
* a range of days reads its bins and keeps a row where its first bin in the
  range is (the first bin wins), so no row comes twice.

Bins run from that of the earliest start to that of the latest start; days
outside count as the nearest bin. An open end (9999-12-31) therefore fills no
more than the bins that some start lies in, and a row takes at most its length
divided by ``width``, plus one. Rows with a null bound or an inverted interval
hold on no day and are not stored: this is an index for lookups, not the
history itself.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.functions.dates import as_of_date
from tenure.sinks.replace import Written, pointer_properties, replace_table

BIN = "day_bin"
MIN_WIDTH, MAX_WIDTH = 7, 3660


@dataclass(frozen=True)
class DayBins:
    """Bins of ``width`` days, numbered from 1970-01-01; days before ``first`` or after ``last`` count to these."""

    width: int
    first: int
    last: int
    start: str = "StartDate"
    end: str = "EndDate"

    def raw(self, day: Column) -> Column:
        return F.floor(F.unix_date(day) / F.lit(self.width)).cast("int")

    def of(self, day: Column) -> Column:
        return F.least(F.greatest(self.raw(day), F.lit(self.first)), F.lit(self.last))

    def spread(self, history: DataFrame) -> DataFrame:
        """Each row once in every bin its interval touches."""
        held = history.filter(F.col(self.start) <= F.col(self.end))
        touched = F.sequence(self.of(F.col(self.start)), self.of(F.col(self.end)))
        return held.withColumn(BIN, F.explode(touched))

    def holds(self, day: Column) -> Column:
        return (F.col(self.start) <= day) & (F.col(self.end) >= day)

    def on(self, binned: DataFrame, as_of: str | dt.date | None = None) -> DataFrame:
        """Rows that hold on one day, from one bin."""
        day = as_of_date(as_of)
        return binned.filter((F.col(BIN) == self.of(day)) & self.holds(day)).drop(BIN)

    def on_days(self, binned: DataFrame, days: DataFrame, day: str = "day") -> DataFrame:
        """(day, row) for every day of a table and every row that holds on it.

        An equi-join on the bin; the days are broadcast only if Spark measures
        them as small, otherwise sorted and merged, bins with very many rows
        being split by AQE.
        """
        asked = days.select(F.col(day).cast("date").alias(day)).filter(F.col(day).isNotNull()).distinct()
        asked = asked.withColumn(BIN, self.of(F.col(day)))
        return binned.join(asked, BIN).filter(self.holds(F.col(day))).drop(BIN)

    def overlapping(self, binned: DataFrame, since: str | dt.date, until: str | dt.date) -> DataFrame:
        """Rows whose interval meets the closed range [since, until], each once."""
        a, b = as_of_date(since), as_of_date(until)
        first = F.greatest(self.of(F.col(self.start)), self.of(a))
        bins = F.col(BIN).between(self.of(a), self.of(b))
        return binned.filter(bins & (F.col(self.start) <= b) & (F.col(self.end) >= a) & (a <= b) & (F.col(BIN) == first)).drop(BIN)


def measured_bins(history: DataFrame, start: str = "StartDate", end: str = "EndDate", width: int | None = None) -> DayBins:
    """Bins that fit a history: its starts' range, and twice the mean length as width (one aggregate)."""
    held = history.filter(F.col(start) <= F.col(end))
    last = F.max(F.unix_date(start))
    # an open end counts as the latest start would: it must not stretch the bins
    days = F.unix_date(F.least(F.col(end), F.date_add(F.col(start), MAX_WIDTH))) - F.unix_date(start)
    got = held.agg(F.min(F.unix_date(start)).alias("lo"), last.alias("hi"), F.avg(days).alias("days")).first()
    if got["lo"] is None:
        return DayBins(width or MIN_WIDTH, 0, 0, start, end)
    width = width or min(MAX_WIDTH, max(MIN_WIDTH, int(2 * got["days"])))
    return DayBins(width, got["lo"] // width, got["hi"] // width, start, end)


def store_binned(
    history: DataFrame, table: str, root: str, *, start: str = "StartDate", end: str = "EndDate", width: int | None = None, run_id: str | None = None, keep: int = 2
) -> tuple[Written, DayBins]:
    """Write ``history`` by bins as the new version of ``table``, served through a pointer.

    Partitions are rebalanced by bin: AQE splits a bin with many rows over many
    files and merges small ones. Inside a file rows are sorted by start, so row
    groups can be skipped too. The bins' numbers are kept on the pointer.
    """
    bins = measured_bins(history, start, end, width)
    rows = bins.spread(history).hint("rebalance", BIN).sortWithinPartitions(BIN, start)
    notes = {f"bins.{k}": str(v) for k, v in vars(bins).items()}
    return replace_table(rows, table, root, run_id=run_id, keep=keep, partition_by=[BIN], pointer=True, properties=notes), bins


def open_binned(spark: SparkSession, table: str) -> tuple[DataFrame, DayBins]:
    """The binned table that a pointer serves, and its bins."""
    notes = {k.removeprefix("bins."): v for k, v in pointer_properties(spark, table).items() if k.startswith("bins.")}
    if not notes:
        raise ValueError(f"{table} is not stored by day bins")
    bins = DayBins(int(notes["width"]), int(notes["first"]), int(notes["last"]), notes["start"], notes["end"])
    return spark.table(table), bins
