"""A stored high-water mark for surrogate ids, leased in blocks.

``IDENTITY`` never gives a number twice, also after rows with the highest ids
were deleted and also when a load failed half-way. A mark taken from the
greatest id of a frame cannot promise that. Here every load leases a block of
numbers before it writes: lease ``k`` is a small folder, written under a name
of its own and then renamed. The first rename to a lease's name wins; whoever
finds another's note there reads it and tries the next name. So no two loads
hold the same numbers, and a load that fails leaves a gap, never a repeat.
Renames are atomic on HDFS and on local disks; on a store where they are not,
one load at a time must run.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenure.operators.numbering import assign_identity

PREFIX, NOTE = "lease-", "lease.json"


def _lease(k: int) -> str:
    return f"{PREFIX}{k:012d}"


class IdentityMark:
    """The leases of one table's ids, in a shared folder."""

    def __init__(self, spark: SparkSession, folder: str, seed: int = 0) -> None:
        self.spark, self.folder, self.seed = spark, folder.rstrip("/"), seed
        self._jvm = spark.sparkContext._jvm
        path = self._jvm.org.apache.hadoop.fs.Path(self.folder)
        self._fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(path)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _note(self, name: str) -> dict:
        stream = self._fs.open(self._path(f"{name}/{NOTE}"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _last(self) -> tuple[int, int]:
        """(number of the last lease, first id that it left free)."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(""))]
        k = max((int(n.removeprefix(PREFIX)) for n in names if n.startswith(PREFIX)), default=0)
        return (k, self._note(_lease(k))["next"]) if k else (0, self.seed)

    def lease(self, count: int, at_least: int | None = None) -> int:
        """Take ``count`` ids; returns the first. ``at_least``: none of them below it."""
        if count < 0:
            raise ValueError("a block of ids cannot be negative")
        while True:
            k, free = self._last()
            first = free if at_least is None else max(free, at_least)
            owner = uuid.uuid4().hex
            stream = self._fs.create(self._path(f"claim-{owner}/{NOTE}"), False)
            stream.write(bytearray(json.dumps({"owner": owner, "first": first, "next": first + count}).encode()))
            stream.close()
            self._fs.rename(self._path(f"claim-{owner}"), self._path(_lease(k + 1)))
            if self._note(_lease(k + 1))["owner"] == owner:
                return first
            for left in (f"claim-{owner}", f"{_lease(k + 1)}/claim-{owner}"):  # another load was faster
                self._fs.delete(self._path(left), True)

    def next_free(self) -> int:
        return self._last()[1]


def load_identity(df: DataFrame, column: str, order: list[str], mark: IdentityMark) -> DataFrame:
    """Fill missing ids in ``column`` from a fresh lease; explicit ids win.

    Explicit ids above the mark move it up first, as an explicit identity
    insert does. One aggregate measures how many ids are needed and the
    greatest explicit one; rows are then numbered by ranges, as in
    ``assign_identity``.
    """
    need = df.agg(F.count_if(F.col(column).isNull()).alias("missing"), F.max(column).alias("top")).first()
    at_least = None if need["top"] is None else int(need["top"]) + 1
    first = mark.lease(int(need["missing"]), at_least)
    return assign_identity(df, column, order, first=first)
