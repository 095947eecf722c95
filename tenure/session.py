"""Session settings and the shared work folder.

The work folder holds intermediate tables (rows with their range positions,
for exact numbering) and, in the registered test queries, run outputs. On a
cluster it is the shared folder named by ``spark.checkpoint.dir``, and without
it there is an error; only a local session (tests, a laptop) falls back to a
folder below the warehouse directory.
"""

from __future__ import annotations

import threading
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings we rely on: runtime re-planning (partition coalescing, skewed join
# splitting, broadcast conversion from measured sizes) and a fixed time zone so
# date casts of timestamps are repeatable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Library knobs, read from the session so a cluster job sets them with --conf.
HOT_GROUP_ROWS = "tenure.hotGroupRows"
HOT_GROUP_ROWS_DEFAULT = 2_000_000
MAX_BROADCAST_ROWS = "tenure.maxBroadcastRows"
MAX_BROADCAST_ROWS_DEFAULT = 2_000_000
ROWS_PER_RANGE = "tenure.rowsPerRange"
ROWS_PER_RANGE_DEFAULT = 4_000_000


def build_session(
    master: str | None = None,
    app_name: str = "tenure",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def sized_conf(
    input_bytes: int,
    *,
    target_partition_bytes: int = 256 << 20,
    cores: int | None = None,
    max_partitions: int = 100_000,
) -> dict[str, str]:
    """Partition settings for an input of ``input_bytes`` (on-disk, compressed).

    Shuffle partitions start at about two per target-sized slice of the input
    (shuffled rows are wider than compressed columns), never below the core
    count and never above ``max_partitions`` (map statuses and shuffle files
    grow with mappers times reducers). AQE then merges partitions towards the
    advisory size, so starting high costs little and keeps sort, window and
    join partitions within executor memory instead of spilling heavily.
    """
    slices = max(1, -(-input_bytes // target_partition_bytes))
    partitions = min(max(2 * slices, cores or 1), max(max_partitions, cores or 1))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def conf_int(spark: SparkSession, key: str, default: int) -> int:
    return int(spark.conf.get(key, str(default)))


def work_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the checkpoint dir when named."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tenure_work"
    return root.rstrip("/")


def new_run_folder(spark: SparkSession, label: str) -> str:
    return f"{work_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


_LOCAL = threading.local()  # scopes are per thread: concurrent jobs keep their own


def _scopes() -> list[list]:
    if not hasattr(_LOCAL, "scopes"):
        _LOCAL.scopes = []
    return _LOCAL.scopes


def keep(df: DataFrame) -> DataFrame:
    """Persist a small, deterministic intermediate (memory, spilling to disk).

    Inside a ``scratch_scope`` it is unpersisted when the scope ends; a lost
    block is recomputed from the same inputs to the same rows.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    if _scopes():
        _scopes()[-1].append(df)
    return df


@contextmanager
def scratch_scope(spark: SparkSession):
    """Release, on leaving, the intermediates made inside: delete the tables
    ``materialize`` wrote and unpersist what ``keep`` persisted.

    For a job whose outputs are written before the block ends (the batch job);
    DataFrames built on those intermediates cannot be evaluated afterwards.
    Intermediates made outside any scope are left to the work folder's
    retention and the session's cache.
    """
    made: list = []
    _scopes().append(made)
    try:
        yield made
    finally:
        _scopes().remove(made)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for item in made:
            if isinstance(item, DataFrame):
                item.unpersist()
            else:
                path = jvm.org.apache.hadoop.fs.Path(item)
                path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once to the shared folder and read it back.

    Used where two readers must see identical rows, such as positions taken
    inside range partitions: stored, they are data rather than a
    recomputation, and the lineage is cut so a lost executor does not rerun
    the producing shuffle. Inside a ``scratch_scope`` the files are deleted
    when the scope ends.
    """
    spark = df.sparkSession
    path = new_run_folder(spark, label)
    df.write.mode("errorifexists").parquet(path)
    if _scopes():
        _scopes()[-1].append(path)
    return spark.read.parquet(path)
