"""Ranking inside groups.

Two shapes occur in the source job and queries:

* the first (or latest) row per employee, i.e. ``row_number() ... = 1``;
* the full ordinal of every history row within its employee.

The first is an aggregate here (``min_by`` / ``max_by`` over a sort key): every
map task collapses its rows to one per group before the shuffle, so a group
holding a third of all rows costs the same as any other. Where the order and the
columns to carry are dates, timestamps and whole numbers, both are packed into
single numbers (``tenure.operators.packing``), so Spark hashes; text has to be
carried in a struct, and Spark sorts instead. Either way the partial step runs
before the exchange.

The second needs every row of a group in order. Groups of ordinary size use a
plain window partitioned by the key. Groups above ``tenure.hotGroupRows`` rows
are found by an exact count first and numbered apart: they are
range-partitioned on (key, order), so one hot group is spread over many tasks,
each row gets its position inside its range partition, and the per-partition
counts of each group (a table bounded by partitions plus hot groups) give the
offsets. This is the idea behind ``zipWithIndex``, expressed with DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.operators.packing import packing_of
from tenure.session import (
    HOT_GROUP_ROWS,
    HOT_GROUP_ROWS_DEFAULT,
    MAX_BROADCAST_ROWS,
    MAX_BROADCAST_ROWS_DEFAULT,
    ROWS_PER_RANGE,
    ROWS_PER_RANGE_DEFAULT,
    conf_int,
    keep,
    materialize,
)

_POS_BITS = 33  # monotonically_increasing_id(): partition index << 33 | row in partition
_LOCAL_MASK = (1 << _POS_BITS) - 1


def sort_key(columns: list[str], descending: bool = False) -> Column:
    """A struct whose natural order is the wanted order with nulls last.

    Each column contributes (null flag, value). Ascending: ``isnull`` first so
    that non-null (false) sorts before null (true). Descending, read with
    ``max``: ``isnotnull`` first so non-null (true) wins over null.
    """
    fields = []
    for i, c in enumerate(columns):
        flag = F.col(c).isNotNull() if descending else F.col(c).isNull()
        fields += [flag.alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    return F.struct(*fields)


def sort_orders(columns: list[str], descending: bool = False) -> list[Column]:
    """The same order as ``sort_key`` as sort expressions (nulls last)."""
    if descending:
        return [F.col(c).desc_nulls_last() for c in columns]
    return [F.col(c).asc_nulls_last() for c in columns]


def all_not_null(columns: list[str]) -> Column:
    cond = F.col(columns[0]).isNotNull()
    for c in columns[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def first_per_group(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    descending: bool = False,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per group: the first under ``order`` (nulls last).

    Later columns of ``order`` break ties of earlier ones; pass a unique column
    last for repeatable answers. Equivalent to ``row_number() over (partition
    by keys order by order) = 1`` but planned as an aggregate with a partial
    (map-side) step, so hot groups shrink to one row per task before the
    shuffle.
    """
    carry = carry if carry is not None else [c for c in df.columns if c not in keys]
    pick = F.max_by if descending else F.min_by
    rank, load = packing_of(df, order, nulls_least=descending), packing_of(df, carry)
    if rank is not None and load is not None:
        packed = df.select(*keys, rank.pack().alias("_rank"), load.pack().alias("_load"))
        return packed.groupBy(*keys).agg(pick("_load", "_rank").alias("_load")).select(*keys, *load.unpack(F.col("_load")))
    top = pick(F.struct(*[F.col(c) for c in carry]), sort_key(order, descending))
    return df.groupBy(*keys).agg(top.alias("_top")).select(*keys, *[F.col(f"_top.{c}").alias(c) for c in carry])


@dataclass
class HotSplit:
    """Rows split by group size. ``hot_keys`` is None when no group is hot.

    ``hot_keys`` holds the key columns and ``_rows`` (the group's size);
    ``hot_rows`` is the total over hot groups, used to size range partitions.
    """

    normal: DataFrame
    hot: DataFrame | None
    hot_keys: DataFrame | None
    broadcastable: bool
    hot_rows: int = 0

    def keys_side(self, columns: list[str] | None = None) -> DataFrame:
        """The hot-key list as a join side, broadcast when its size allowed."""
        assert self.hot_keys is not None
        side = self.hot_keys.select(*columns) if columns else self.hot_keys
        return F.broadcast(side) if self.broadcastable else side

    def range_partitions(self, spark) -> int:
        """Enough range partitions that each holds about ``tenure.rowsPerRange`` rows."""
        per = conf_int(spark, ROWS_PER_RANGE, ROWS_PER_RANGE_DEFAULT)
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return max(base, -(-self.hot_rows // per))


def split_hot_groups(df: DataFrame, keys: list[str], min_rows: int | None = None) -> HotSplit:
    """Separate groups with at least ``min_rows`` rows from the rest.

    The count is exact: a partial aggregate over the key columns only (Catalyst
    prunes everything else from the source plan), so a hot key is one row per
    task before the shuffle. One job both computes and measures the list, which
    is kept persisted for the joins below. The list is
    deterministic, so a lost block is recomputed to the same keys. There are at
    most ``rows / min_rows`` hot groups; the list is broadcast only when its
    measured length is under ``tenure.maxBroadcastRows``, otherwise the split
    joins are left to the planner (sort-merge with AQE skew handling).
    A non-positive ``min_rows`` turns the split off.
    """
    spark = df.sparkSession
    if min_rows is None:
        min_rows = conf_int(spark, HOT_GROUP_ROWS, HOT_GROUP_ROWS_DEFAULT)
    if min_rows <= 0:
        return HotSplit(df, None, None, True)
    limit = conf_int(spark, MAX_BROADCAST_ROWS, MAX_BROADCAST_ROWS_DEFAULT)
    hot_keys = keep(
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") >= F.lit(min_rows))
    )
    measured = hot_keys.agg(F.count(F.lit(1)).alias("n"), F.sum("_rows").alias("rows")).first()
    if measured["n"] == 0:
        hot_keys.unpersist()
        return HotSplit(df, None, None, True)
    broadcastable = measured["n"] <= limit
    side = F.broadcast(hot_keys) if broadcastable else hot_keys
    normal = df.join(side, keys, "left_anti")
    hot = df.join(side, keys, "left_semi")
    return HotSplit(normal, hot, hot_keys, broadcastable, int(measured["rows"]))


def number_by_ranges(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    name: str = "rn",
    start: int = 1,
    descending: bool = False,
    num_partitions: int | None = None,
) -> DataFrame:
    """Exact ``row_number()`` within ``keys`` (or over everything when ``keys``
    is empty), computed without putting a whole group in one task.

    1. Range-partition on (keys, order) and sort inside each partition; a
       large group spans many partitions. Without ``num_partitions`` the
       session's shuffle partitions are used and AQE may merge neighbouring
       (small) ranges, which keeps ranges contiguous and in order.
    2. Record each row's position in its partition and write the result to the
       shared work folder: positions become stored data, so the two readers
       below agree even if a stage is re-run.
    3. Count rows per (partition, group) and take running totals over the
       partitions of each group: at most partitions + groups rows, broadcast
       when measured under ``tenure.maxBroadcastRows``.
    4. Number = rows of the group in earlier partitions + position within it.

    Numbers are 64-bit. Rows with a null key are dropped (filter them first).
    """
    spark = df.sparkSession
    orders = [F.col(k).asc_nulls_last() for k in keys] + sort_orders(order, descending)
    ranged = df.repartitionByRange(num_partitions, *orders) if num_partitions else df.repartitionByRange(*orders)
    positioned = (
        ranged.sortWithinPartitions(*orders)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    stored = materialize(positioned, "ranged-positions")
    stored = stored.withColumn("_part", F.shiftright("_pos", _POS_BITS)).withColumn(
        "_local", F.col("_pos").bitwiseAND(F.lit(_LOCAL_MASK))
    )
    spans = stored.groupBy("_part", *keys).agg(
        F.count(F.lit(1)).alias("_cnt"), F.min("_local").alias("_first")
    )
    # One row per (partition, group): bounded by partitions + groups, so the
    # window below is small even without keys (one ordered pass over <= n rows).
    by_part = Window.partitionBy(*keys).orderBy("_part") if keys else Window.orderBy("_part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_cnt").over(earlier), F.lit(0)))
    spans = spans.select("_part", *keys, "_before", "_first")
    if keys:
        # partitions + distinct keys rows: small for hot keys, but measured
        # before broadcasting since a caller may pass any number of keys.
        spans = keep(spans)
        small = spans.count() <= conf_int(spark, MAX_BROADCAST_ROWS, MAX_BROADCAST_ROWS_DEFAULT)
    else:
        small = True  # at most one row per range partition
    numbered = stored.join(F.broadcast(spans) if small else spans, ["_part", *keys])
    value = F.col("_before") + F.col("_local") - F.col("_first") + F.lit(start)
    return numbered.withColumn(name, value.cast("bigint")).select(*df.columns, name)


def number_within(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    name: str = "rn",
    descending: bool = False,
    min_hot_rows: int | None = None,
) -> DataFrame:
    """Exact ``row_number()`` over (partition by keys order by order, nulls last), 64-bit.

    Rows with a null key get no number and are dropped, as a join on the key
    would drop them anyway. Ordinary groups go through one window; hot groups
    through ``number_by_ranges``. Callers that join on the key right after
    should use ``split_hot_groups`` themselves, to keep the window's key
    partitioning for the join.
    """
    df = df.filter(all_not_null(keys))
    split = split_hot_groups(df, keys, min_hot_rows)
    w = Window.partitionBy(*keys).orderBy(*sort_orders(order, descending))
    out = split.normal.withColumn(name, F.row_number().over(w).cast("bigint"))
    if split.hot is not None:
        ranged = number_by_ranges(
            split.hot, keys, order, name=name, descending=descending,
            num_partitions=split.range_partitions(df.sparkSession),
        )
        out = out.unionByName(ranged)
    return out


def prefix_by_ranges(df: DataFrame, order: list[str], weight: str, *, name: str = "_before") -> DataFrame:
    """Sum of ``weight`` over all rows before each row in ``order`` (nulls last).

    The weighted form of ``number_by_ranges``: rows are range-partitioned and
    their positions stored; per-partition totals (one row per partition) give
    the offsets, and a window inside each range partition (never more than
    one partition's rows) gives the running sum. Ties in ``order`` are broken
    by stored position, so give a unique order for repeatable answers.
    """
    orders = sort_orders(order)
    positioned = (
        df.repartitionByRange(*orders).sortWithinPartitions(*orders).withColumn("_pos", F.monotonically_increasing_id())
    )
    stored = materialize(positioned, "weighted-positions")
    stored = stored.withColumn("_part", F.shiftright("_pos", _POS_BITS)).withColumn(
        "_local", F.col("_pos").bitwiseAND(F.lit(_LOCAL_MASK))
    )
    totals = stored.groupBy("_part").agg(F.sum(weight).alias("_w"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_off"))
    within = Window.partitionBy("_part").orderBy("_local").rowsBetween(Window.unboundedPreceding, -1)
    out = stored.join(F.broadcast(offsets), "_part")
    out = out.withColumn(name, (F.col("_off") + F.coalesce(F.sum(weight).over(within), F.lit(0))).cast("bigint"))
    return out.select(*df.columns, name)
