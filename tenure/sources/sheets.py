"""Sheet exports whose values hold line breaks, read by records in parallel.

A CSV file is usually split at line ends, so a quoted value with a line break
is torn; reading whole files instead puts each file in one task. Here the lines
are read in parallel and put together again to records: a line begins a record
where the number of quotes before it in its file is even. That number is a
running sum inside each split (a window that never holds more than a split)
plus the totals of the splits before (one row per split). Lines that are a
record by themselves go straight on; only the lines of broken ones are
shuffled, by their record.

Defined results: quotes inside a value are doubled; a line break inside quotes
is part of the value, whichever kind; a line end is a line feed with or without
a carriage return; blank lines between records are skipped; an empty folder of
files gives no row; a record that does not fit the schema, or a quote that is
never closed, fails the read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.session import materialize


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, id, line): lines with their place; ids grow inside a block of a file."""
    lines = spark.read.option("lineSep", "\n").text(path)
    place = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.col("value").alias("line"),
    )
    return materialize(place, "sheet-lines")


def records(lines: DataFrame) -> DataFrame:
    """(file, block, id, record): whole records, placed where their first line is."""
    quotes = lines.withColumn("quotes", F.length("line") - F.length(F.translate("line", '"', "")))
    blocks = quotes.groupBy("file", "block").agg(F.sum("quotes").alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    placed = quotes.join(blocks, ["file", "block"])
    placed = placed.withColumn("open", (F.col("before") + F.coalesce(F.sum("quotes").over(inside), F.lit(0))) % 2 == 1)
    whole = placed.filter(~F.col("open") & (F.col("quotes") % 2 == 0)).select("file", "block", "id", F.col("line").alias("record"))
    torn = placed.filter(F.col("open") | (F.col("quotes") % 2 == 1)).withColumn("first", F.when(~F.col("open"), F.struct("block", "id")))
    # the record a torn line belongs to: the last one begun before it, in its block or an earlier one
    begun = torn.groupBy("file", "block").agg(F.max("first").alias("last"))
    begun = begun.select("file", "block", F.max("last").over(earlier).alias("carried"))
    here = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    torn = torn.withColumn("own", F.max("first").over(here)).join(begun, ["file", "block"])
    torn = torn.withColumn("at", F.coalesce("own", "carried"))
    parts = F.array_sort(F.collect_list(F.struct("block", "id", "line")))
    joined = torn.groupBy("file", "at").agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"))
    return whole.unionByName(joined.select("file", "at.block", "at.id", "record"))


def read_sheet(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = True,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """A folder of CSV files under a declared schema; values may hold line breaks."""
    found = records(numbered_lines(spark, path))
    if header:
        first = found.groupBy("file").agg(F.min(F.struct("block", "id")).alias("top"))
        found = found.join(first, "file").filter(F.struct("block", "id") > F.col("top"))
    text = F.regexp_replace("record", "\r$", "")
    options = {
        "mode": "FAILFAST", "dateFormat": date_format, "escape": '"', "multiLine": "true",
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
    }
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    parsed = found.select(text.alias("record")).filter("record != ''")
    parsed = parsed.select(F.from_csv("record", nullable.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options).alias("r"))
    return parsed.select("r.*")
