"""Choosing tables by name, and copying a list of tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession

from tenure.sinks.replace import replace_table, verify_landed


def tables_named(spark: SparkSession, names: Iterable[str], database: str | None = None) -> list[str]:
    """Catalog tables whose name is in ``names`` (case-insensitive), in catalog order.

    Reads catalog metadata only. Feeds ``copy_tables``.
    """
    wanted = {n.lower() for n in names}
    return [t.name for t in spark.catalog.listTables(database) if t.name.lower() in wanted]


def copy_tables(
    spark: SparkSession,
    names: Iterable[str],
    read: Callable[[str], DataFrame],
    root: str,
    *,
    prefix: str = "src_",
    run_id: str | None = None,
    bucket_by: dict[str, tuple[int, list[str]]] | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Copy each named table to ``<root>/<prefix><name>`` with a staged full replace.

    Each table is one Spark job (read, write), which also observes the rows'
    count and an order-free digest of their content. Both are taken again from
    the landed copy and must be equal, else this raises: a lost, repeated or
    altered row fails the copy. Returns ``(table_name, target, rows_copied,
    running_total, digest)``, totalled in the order of ``names``.
    The list is of table names; the copy never iterates over cell values.
    ``bucket_by`` maps a table name to ``(buckets, columns)`` for copies that
    later queries join on those columns. Up to ``parallel`` copies run as
    concurrent Spark jobs, so many small tables do not leave the cluster idle.
    """
    names = list(names)
    if not names:
        raise ValueError("no tables to copy")

    def one(name: str) -> tuple[str, str, int, str]:
        target = f"{prefix}{name}"
        spec = (bucket_by or {}).get(name)
        written = replace_table(read(name), target, root, run_id=run_id, bucket_by=spec, digest=True, check=verify_landed)
        return name, target, written.rows, written.digest

    with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(names)))) as pool:
        copies = list(pool.map(one, names))  # results in the order of names; errors re-raised
    totals = accumulate(rows for *_, rows, _ in copies)
    report = [(name, target, rows, total, digest) for (name, target, rows, digest), total in zip(copies, totals, strict=True)]
    return spark.createDataFrame(report, "table_name string, target string, rows_copied bigint, running_total bigint, digest string")
