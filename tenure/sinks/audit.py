"""Run audit: one row per step of a batch run, appended to a table.

Rows are partitioned by the day a run began, so what one run did is read from
one partition however long the audit has been kept. Each step appends a small
file; ``compact`` puts the files of finished days together.
"""

from __future__ import annotations

import datetime as dt
import re
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("seq", T.IntegerType(), False),
        T.StructField("step", T.StringType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("started_at", T.TimestampType(), False),
        T.StructField("finished_at", T.TimestampType(), False),
        T.StructField("rows", T.LongType(), True),
        T.StructField("detail", T.StringType(), True),
    ]
)


class StepResult:
    def __init__(self) -> None:
        self.rows: int | None = None
        self.detail: str | None = None


DAY = "run_date"


def _day_of(run_id: str) -> dt.date | None:
    """The day that a run id names (those made here begin with the time)."""
    found = re.match(r"(\d{4})(\d{2})(\d{2})T", run_id)
    return dt.date(*map(int, found.groups())) if found else None


def audit_rows(spark: SparkSession, path: str) -> DataFrame:
    """Every recorded step, with ``run_date``; filters on it read those partitions alone."""
    schema = T.StructType([*AUDIT_SCHEMA.fields, T.StructField(DAY, T.DateType())])
    # while a day is being compacted its rows may be there twice
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/days").distinct()


class Audit:
    """Append-only step log at ``path`` (parquet, by day), keyed by ``run_id``.

    A step that raises is recorded as ``failed`` with the error text and the
    error is re-raised: a half-finished run is visible and never reported as a
    success. The day is the one in the run id, or ``run_date``, or the day of
    the first step; a run that was only named (to be read) and has none of
    these is looked for on all days.
    """

    def __init__(self, spark: SparkSession, path: str, run_id: str, run_date: dt.date | None = None) -> None:
        self.spark, self.path, self.run_id, self.seq = spark, path, run_id, 0
        self.run_date = run_date or _day_of(run_id)
        self._lock = threading.Lock()

    def _append(self, step, status, started, finished, rows, detail) -> None:
        # Steps may finish concurrently; appends to one folder are serialised.
        with self._lock:
            self.seq += 1
            self.run_date = self.run_date or started.date()
            row = (self.run_id, self.seq, step, status, started, finished, rows, detail)
            out = self.spark.createDataFrame([row], AUDIT_SCHEMA).withColumn(DAY, F.lit(self.run_date))
            out.coalesce(1).write.mode("append").partitionBy(DAY).parquet(f"{self.path.rstrip('/')}/days")

    @contextmanager
    def step(self, name: str):
        started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        result = StepResult()
        try:
            yield result
        except Exception as exc:
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            self._append(name, "failed", started, now, result.rows, f"{type(exc).__name__}: {exc}")
            raise
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self._append(name, "ok", started, now, result.rows, result.detail)

    def frame(self) -> DataFrame:
        """This run's steps."""
        rows = audit_rows(self.spark, self.path)
        if self.run_date is not None:
            rows = rows.filter(F.col(DAY) == F.lit(self.run_date))
        return rows.filter(F.col("run_id") == self.run_id).drop(DAY)


def compact(spark: SparkSession, path: str, before: dt.date) -> list[dt.date]:
    """Put the files of every day before ``before`` into one file a day; returns the days.

    The new file is added first and the old ones deleted afterwards; a reader
    in between finds rows twice, which ``audit_rows`` makes one, and none is
    ever missing. A compaction that is cut off is done again by the next.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path_of = jvm.org.apache.hadoop.fs.Path
    root = path_of(f"{path.rstrip('/')}/days")
    fs = root.getFileSystem(conf)
    done = []
    for folder in fs.listStatus(root) if fs.exists(root) else []:
        name = folder.getPath().getName()
        if not name.startswith(f"{DAY}="):
            continue
        day = dt.date.fromisoformat(name.removeprefix(f"{DAY}="))
        old = [f.getPath() for f in fs.listStatus(folder.getPath()) if f.getPath().getName().endswith(".parquet")]
        if day >= before or len(old) < 2:
            continue
        staged = f"{path.rstrip('/')}/staged-{uuid.uuid4().hex[:12]}"
        rows = spark.read.schema(AUDIT_SCHEMA).parquet(*[p.toString() for p in old]).distinct()
        rows.coalesce(1).write.parquet(staged)  # one day's steps: a few rows a run
        for f in fs.listStatus(path_of(staged)):
            if f.getPath().getName().endswith(".parquet"):
                fs.rename(f.getPath(), path_of(folder.getPath(), f"compact-{uuid.uuid4().hex[:12]}.parquet"))
        for f in old:
            fs.delete(f, False)
        fs.delete(path_of(staged), True)
        done.append(day)
    return sorted(done)
