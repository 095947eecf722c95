"""Full replacement of a table without overwriting what readers use.

Each run writes a new version folder ``<root>/<table>/version-<run_id>``;
only after the write has succeeded is the catalog table pointed at it. A
failed write leaves the previous version in place, and a query that was
reading the old files keeps its files. Older versions beyond ``keep`` are
removed afterwards. Row counts (and, on request, a digest of the content) are
observed during the write itself.

Two ways to point:

* a table whose location is moved. While the layout stays the same that is one
  catalog change; a new schema, format or bucketing has to drop the table and
  create it again, and a reader in between finds none;
* ``pointer=True``: every version is an external table of its own
  (``<table>__v_<run_id>``), and ``<table>`` is a view over the served one,
  switched by a single ``CREATE OR REPLACE VIEW``. Readers always find one whole
  version, whatever changed. The view's properties name the version, its
  folder, rows and digest; ``serve_version`` goes back to one that was kept.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tenure.operators.digest import content_digest, digest_aggregates, digest_text

VERSION_PREFIX = "version-"
POINTER_PREFIX = "tenure."


def new_run_id() -> str:
    """Sortable by time, unique across concurrent runs."""
    return dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:6]


@dataclass
class Written:
    table: str
    path: str
    fmt: str
    rows: int
    options: dict[str, str]
    digest: str | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def path_frame(self, spark: SparkSession, schema=None) -> DataFrame:
        reader = spark.read.format(self.fmt).options(**self.options)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.load(self.path)


def replace_table(
    df: DataFrame,
    table: str,
    root: str,
    *,
    run_id: str | None = None,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    register: bool = True,
    keep: int = 2,
    bucket_by: tuple[int, list[str]] | None = None,
    partition_by: list[str] | None = None,
    pointer: bool = False,
    digest: bool = False,
    check: Callable[[SparkSession, Written], None] | None = None,
    properties: dict[str, str] | None = None,
) -> Written:
    """Write ``df`` as the new version of ``table`` and switch to it.

    ``register=False`` writes the version folder only (for file exports).
    ``bucket_by=(n, columns)`` stores the table hash-bucketed and sorted on
    ``columns``: later joins, windows and aggregates on those columns between
    tables bucketed alike read without any shuffle.
    ``pointer=True`` serves the versions through a view (see above), which also
    allows ``partition_by`` and own ``properties`` on the pointer.
    ``digest=True`` observes an order-free digest of the rows as they are
    written. ``check`` is called with the landed version before it is served
    (``verify_landed``, say); if it raises, the served version stays.
    Returns where it landed, how many rows were written and their digest.
    """
    if partition_by and not pointer:
        raise ValueError("partitioned versions are served through a pointer (pointer=True)")
    if properties and not pointer:
        raise ValueError("properties are kept on a pointer (pointer=True)")
    spark = df.sparkSession
    run_id = run_id or new_run_id()
    options = dict(options or {})
    table_root = f"{root.rstrip('/')}/{table.split('.')[-1]}"
    path = f"{table_root}/{VERSION_PREFIX}{run_id}"
    obs = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    measures = [F.count(F.lit(1)).alias("rows"), *(digest_aggregates(df) if digest else [])]
    writer = df.observe(obs, *measures).write.format(fmt).options(**options)
    if pointer:
        version = _version_table(table, run_id)
        if bucket_by is not None:
            n, cols = bucket_by
            writer = writer.bucketBy(n, *cols).sortBy(*cols)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.option("path", path).mode("errorifexists").saveAsTable(version)
    elif bucket_by is None:
        writer.mode("errorifexists").save(path)
    else:
        if not register:
            raise ValueError("bucketed output needs a catalog table (register=True)")
        n, cols = bucket_by
        staging = f"{table}__staging_{uuid.uuid4().hex[:8]}"
        writer.bucketBy(n, *cols).sortBy(*cols).option("path", path).mode("errorifexists").saveAsTable(staging)
    rows = int(obs.get["rows"])
    written = Written(table, path, fmt, rows, options, digest_text(obs.get) if digest else None, dict(properties or {}))
    if check is not None:
        try:
            check(spark, written)
        except Exception:
            for unserved in [version] if pointer else [staging] if bucket_by is not None else []:
                spark.sql(f"DROP TABLE IF EXISTS {unserved}")  # external: its files stay
            raise
    if pointer:
        if register:
            _switch_pointer(spark, written, version, run_id)
            if keep:
                _prune_pointed(spark, table, table_root, keep, {version, _served(spark, table)})
        return written
    if bucket_by is not None:
        _swap_staging(spark, table, staging, path)
    elif register:
        _point_table(spark, table, path, fmt, options, df.schema)
    if keep:
        _prune_versions(spark, table_root, keep, {path, *([_location(spark, table)] if register else [])})
    return written


def verify_landed(spark: SparkSession, written: Written) -> None:
    """Read a landed version back; raise unless it holds the rows that were written."""
    rows, digest = content_digest(written.path_frame(spark))
    if rows != written.rows:
        raise ValueError(f"{written.table}: {written.rows} rows written, {rows} landed")
    if digest != written.digest:
        raise ValueError(f"{written.table}: the {rows} landed rows differ from those written")


def _version_table(table: str, run_id: str) -> str:
    return f"{table}__v_{re.sub(r'[^0-9A-Za-z_]', '_', run_id)}".lower()


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _is_view(spark: SparkSession, table: str) -> bool:
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return info.get("Type") == "VIEW"


def _switch_pointer(spark: SparkSession, written: Written, version: str, run_id: str) -> None:
    """Make the view serve ``version``: one catalog change."""
    table = written.table
    if spark.catalog.tableExists(table) and not _is_view(spark, table):
        # A table from before pointers: it gives way to the view once (its files stay).
        _refuse_managed(spark, table)
        spark.sql(f"DROP TABLE {table}")
    notes = {"version": run_id, "table": version, "path": written.path, "rows": str(written.rows)} | written.properties
    if written.digest is not None:
        notes["digest"] = written.digest
    listed = ", ".join(f"{_quoted(POINTER_PREFIX + k)} = {_quoted(v)}" for k, v in notes.items())
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({listed}) AS SELECT * FROM {version}")


def pointer_properties(spark: SparkSession, table: str) -> dict[str, str]:
    """What the pointer says of the version it serves: ``version``, ``table``, ``path``, ``rows``, ..."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return {k.removeprefix(POINTER_PREFIX): v for k, v in found.items() if k.startswith(POINTER_PREFIX)}


def _served(spark: SparkSession, table: str) -> str:
    return pointer_properties(spark, table).get("table", "")


def kept_versions(spark: SparkSession, table: str) -> list[str]:
    """The tables of all versions that are kept, in the order of their run ids."""
    database, _, name = table.rpartition(".")
    found = spark.sql(f"SHOW TABLES{' IN ' + database if database else ''} LIKE '{name.lower()}__v_*'").collect()
    prefix = f"{database}." if database else ""
    return sorted(prefix + r["tableName"] for r in found if not r["isTemporary"])


def serve_version(spark: SparkSession, table: str, run_id: str) -> None:
    """Point ``table`` at a kept version again (to go back, or forward)."""
    version = _version_table(table, run_id)
    if version not in kept_versions(spark, table):
        raise ValueError(f"{table} keeps no version {run_id}")
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {version}").collect()}
    rows = spark.table(version).count()
    _switch_pointer(spark, Written(table, info["Location"], info["Provider"], rows, {}), version, run_id)


def _prune_pointed(spark: SparkSession, table: str, table_root: str, keep: int, served: set[str]) -> None:
    """Drop all but the ``keep`` newest version tables, with their folders; never a served one."""
    folders = {}
    for version in kept_versions(spark, table):
        folders[version] = _location(spark, version)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    made = {}
    for version, folder in folders.items():
        path = jvm.org.apache.hadoop.fs.Path(folder)
        fs = path.getFileSystem(conf)
        made[version] = fs.getFileStatus(path).getModificationTime() if fs.exists(path) else 0
    for version in sorted(folders, key=lambda v: (made[v], v))[:-keep]:
        if version not in served:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
            path = jvm.org.apache.hadoop.fs.Path(folders[version])
            path.getFileSystem(conf).delete(path, True)


def _layout(spark: SparkSession, table: str) -> tuple:
    """Schema and bucketing of a catalog table, for deciding if a repoint suffices."""
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    keys = ("Num Buckets", "Bucket Columns", "Sort Columns", "Provider")
    return (spark.table(table).schema.simpleString(), *(info.get(k) for k in keys))


def _location(spark: SparkSession, table: str) -> str:
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return info.get("Location") or ""


def _refuse_managed(spark: SparkSession, table: str) -> None:
    """Dropping a managed table would delete its files, so a replace never does."""
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if info.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} exists and is not an external table; not replacing it")


def _swap_staging(spark: SparkSession, table: str, staging: str, path: str) -> None:
    """Make ``table`` serve the files of the (external) staging table."""
    if spark.catalog.tableExists(table):
        _refuse_managed(spark, table)
        if _layout(spark, table) == _layout(spark, staging):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.sql(f"REFRESH TABLE {table}")
            spark.sql(f"DROP TABLE {staging}")  # external: its files are now the table's
            return
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")


def _point_table(spark: SparkSession, table: str, path: str, fmt: str, options: dict[str, str], schema) -> None:
    opts = "".join(f", '{k}' '{v}'" for k, v in options.items())
    create = f"CREATE TABLE {table} USING {fmt} OPTIONS (path '{path}'{opts})"
    if spark.catalog.tableExists(table):
        _refuse_managed(spark, table)
        shape, buckets, *_, provider = _layout(spark, table)
        if shape == schema.simpleString() and not buckets and (provider or "").lower() == fmt.lower():
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.sql(f"REFRESH TABLE {table}")
            return
        # New shape, format or bucketing: the catalog entry has to be recreated (files stay).
        spark.sql(f"DROP TABLE {table}")
    spark.sql(create)


def _prune_versions(spark: SparkSession, table_root: str, keep: int, served: set[str]) -> None:
    """Delete all but the ``keep`` most recently finished version folders of one table.

    Folders in ``served`` (the one just written, the one the catalog points
    at) stay whatever their run id or age.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(table_root)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return
    live = {jvm.org.apache.hadoop.fs.Path(p).getName() for p in served if p}
    versions = sorted(
        (s for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith(VERSION_PREFIX)),
        key=lambda s: s.getModificationTime(),
    )
    for old in versions[:-keep]:
        if old.getPath().getName() not in live:
            fs.delete(old.getPath(), True)
