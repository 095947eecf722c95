"""The questions users ask of an employee table and a position history.

All functions take and return DataFrames; nothing is collected. The join key
is normalised once into ``_k`` on both sides (exact text by default, or the
source database's case-insensitive collation), so every join below is an
ordinary equi-join that can broadcast a small side or reuse partitioning.

Column sets follow the declared schemas; an attribute a source lacks (a
stand-in without birth dates, say) is left out rather than invented.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.functions.dates import parse_date, whole_days
from tenure.functions.text import EXACT, JOIN_KEY, stringify, with_join_key
from tenure.operators.ranking import (
    HotSplit,
    first_per_group,
    number_by_ranges,
    prefix_by_ranges,
    sort_orders,
    split_hot_groups,
)
from tenure.operators.temporal import valid_at
from tenure.session import HOT_GROUP_ROWS, HOT_GROUP_ROWS_DEFAULT, MAX_BROADCAST_ROWS, MAX_BROADCAST_ROWS_DEFAULT, conf_int, keep
from tenure.schemas import (
    EMPLOYEE_ATTRS,
    KEY,
    POSITION_ATTRS,
    TRAINING_FACT_COLUMNS,
    TRAINING_HISTORY_COLUMNS,
    TRAINING_PERIOD_COLUMNS,
    present,
)

K = JOIN_KEY
PERIOD = ["StartDate", "EndDate"]


def _position_columns(hist: DataFrame) -> list[str]:
    return [*present(POSITION_ATTRS, hist.columns), "PhEmployeeId", *PERIOD]


def _history_for_lookup(hist: DataFrame, key_mode: str, extra: list[str] | None = None) -> DataFrame:
    """History with the key kept as ``PhEmployeeId`` and null keys dropped."""
    h = hist.select(
        *(extra or []),
        F.col("Id").alias("_hid"),
        *present(POSITION_ATTRS, hist.columns),
        F.col(KEY).alias("PhEmployeeId"),
        *PERIOD,
    )
    return with_join_key(h, "PhEmployeeId", key_mode).filter(F.col(K).isNotNull())


def current_position(
    emp: DataFrame,
    hist: DataFrame,
    as_of: str | dt.date | Column | None = None,
    *,
    key_mode: str = EXACT,
) -> DataFrame:
    """Each employee with the position(s) whose closed interval holds ``as_of``.

    The interval filter runs on the history before the join (it reaches the
    parquet scan as pushed filters). Employees with no valid position are not
    listed, as in the source query, whose filter on right-side columns turns
    its left join into an inner one. ``as_of=None`` means today.
    """
    return positions_held(emp, valid_at(hist, as_of), key_mode=key_mode)


def positions_held(emp: DataFrame, held: DataFrame, *, key_mode: str = EXACT, extra: list[str] | None = None) -> DataFrame:
    """Employees with the history rows ``held`` by them, found by whichever lookup.

    ``extra`` names columns of ``held`` to put first (the day that was asked for, say).
    """
    extra = list(extra or [])
    e_attrs = present(EMPLOYEE_ATTRS, emp.columns)
    e = with_join_key(emp.select(*e_attrs), KEY, key_mode)
    h = _history_for_lookup(held, key_mode, extra)
    return e.join(h, K, "inner").select(*extra, *e_attrs, *_position_columns(held))


def latest_per_employee(hist: DataFrame, key_mode: str = EXACT) -> DataFrame:
    """The latest position per key: greatest start (nulls last), ties to the greater Id."""
    h = _history_for_lookup(hist, key_mode)
    carry = [c for c in h.columns if c not in (K, "_hid")]
    return first_per_group(h, [K], ["StartDate", "_hid"], descending=True, carry=carry)


def latest_position(
    emp: DataFrame,
    hist: DataFrame,
    *,
    literal: bool = False,
    key_mode: str = EXACT,
) -> DataFrame:
    """Each employee with their latest position.

    Default (the stated intent, "all the employees"): every employee row once,
    with nulls when there is no history.

    ``literal=True`` reproduces the source query exactly: it ranks after the
    left join over the *history* key, so all employees without history share
    one null partition and only one of them survives (the smallest Id); where
    employee keys repeat, one employee row per key survives likewise.
    """
    e_attrs = present(EMPLOYEE_ATTRS, emp.columns)
    out = [*e_attrs, *_position_columns(hist)]
    latest = latest_per_employee(hist, key_mode)
    if not literal:
        e = with_join_key(emp.select(*e_attrs), KEY, key_mode)
        return e.join(latest, K, "left").select(*out)

    e = with_join_key(emp.select(F.col("Id").alias("_eid"), *e_attrs), KEY, key_mode)
    # Employees without history share the null group; the aggregate's partial
    # step leaves one row of it per task, so it never fills one task.
    joined = e.join(latest, K, "left").withColumn("_hk", F.when(F.col("PhEmployeeId").isNotNull(), F.col(K)))
    return first_per_group(joined, ["_hk"], ["_eid", KEY], carry=out).select(*out)


def _history_with_duration(hist: DataFrame, key_mode: str) -> DataFrame:
    """History renamed for the wide output, with whole days, keyed, null keys dropped."""
    h = hist.select(
        F.col("Id").alias("Id_PositionHistory"),
        *present(POSITION_ATTRS, hist.columns),
        F.col(KEY),
        parse_date(hist, "StartDate"),
        parse_date(hist, "EndDate"),
    )
    h = h.withColumn("training_day_duration", whole_days(h, "StartDate", "EndDate"))
    return with_join_key(h, KEY, key_mode).filter(F.col(K).isNotNull()).drop(KEY)


def _employee_for_training(emp: DataFrame, key_mode: str) -> DataFrame:
    e = emp.select(F.col("Id").alias("Id_Employee"), *present(EMPLOYEE_ATTRS, emp.columns))
    return with_join_key(e, KEY, key_mode)


TRAINING_ORDER = ["StartDate", "Id_PositionHistory"]


def training_history(
    emp: DataFrame,
    hist: DataFrame,
    *,
    key_mode: str = EXACT,
    golden: bool = False,
    min_hot_rows: int | None = None,
    row_index: bool = False,
) -> DataFrame:
    """Every employee with every position, its whole days and its ordinal ``rn``.

    ``rn`` numbers an employee's positions by start (nulls last, ties by Id);
    ``rn = 1`` is taken as the training position. Employees without history
    appear once with nulls. The history is hash-partitioned by key for the
    window and the left join reuses that partitioning (one exchange per side).
    Keys with more than ``tenure.hotGroupRows`` positions are numbered by
    ranges instead and joined separately, so no task holds a whole hot key.
    ``golden=True`` types the two counts as doubles, as in the CSV the source
    job produced. ``row_index=True`` adds the 0-based ``row_index`` over
    ``CSV_ORDER`` as the first column (see ``_employee_offsets``).
    """
    e = _employee_for_training(emp, key_mode)
    h = _history_with_duration(hist, key_mode)
    offsets, most = _employee_offsets(e, h) if row_index else (None, None)
    if offsets is not None:
        e = e.join(offsets, ["Id_Employee", "EmployeeId"], "inner")
    if min_hot_rows is None:
        min_hot_rows = conf_int(emp.sparkSession, HOT_GROUP_ROWS, HOT_GROUP_ROWS_DEFAULT)
    # the offsets' job has already measured the largest group: without a hot one no second count is needed
    split = HotSplit(h, None, None, True) if most is not None and most < min_hot_rows else split_hot_groups(h, [K], min_hot_rows)
    w = Window.partitionBy(K).orderBy(*sort_orders(TRAINING_ORDER))
    # 64-bit: one employee may hold more positions than an int can count.
    numbered = split.normal.withColumn("rn", F.row_number().over(w).cast("bigint"))
    if split.hot is None:
        wide = e.join(numbered, K, "left")
    else:
        wide = e.join(split.keys_side(), K, "left_anti").join(numbered, K, "left")
        hot = number_by_ranges(
            split.hot, [K], TRAINING_ORDER, num_partitions=split.range_partitions(emp.sparkSession)
        )
        wide = wide.unionByName(_join_hot_employees(e, hot, split))
    cols = present(TRAINING_HISTORY_COLUMNS, wide.columns)
    if offsets is not None:
        index = F.col("_before") + F.coalesce(F.col("rn"), F.lit(1)) - F.lit(1)
        wide = wide.select(index.alias("row_index"), *cols)
    else:
        wide = wide.select(*cols)
    if golden:
        wide = wide.withColumn("training_day_duration", F.col("training_day_duration").cast("double"))
        wide = wide.withColumn("rn", F.col("rn").cast("double"))
    if row_index and offsets is None:
        wide = with_row_index(wide)
    return wide


def _employee_offsets(e: DataFrame, h: DataFrame) -> tuple[DataFrame | None, int]:
    """Where each employee's rows start in ``CSV_ORDER``, without touching the wide table; and the largest group's size.

    With (Id_Employee, EmployeeId) unique and non-null (the declared keys),
    an employee's wide rows are consecutive in ``CSV_ORDER``, ordered by
    ``rn``: there are max(positions, 1) of them. The start is therefore a
    weighted prefix sum over the employee table alone, computed by ranges.
    The wide row's index is then start + rn - 1, and the wide table is never
    shuffled or written for it. The keys are counted and the weights summed in
    one aggregate, which is written once; whether keys repeat, and how large
    the largest group is, are read from it. If keys repeat or hold a null the
    offsets are None; the caller then numbers the wide rows by ranges instead.
    """
    units = ["Id_Employee", "EmployeeId"]
    per_key = h.groupBy(K).agg(F.count(F.lit(1)).alias("_c"))
    one = F.greatest(F.coalesce(F.col("_c"), F.lit(0)), F.lit(1))
    # outer on both sides: a key that no employee has may be the largest group too; such keys come last and weigh nothing
    both = e.select(*units, K, F.lit(1).alias("_e")).join(per_key, K, "full")
    grouped = both.groupBy("_e", *units).agg(F.count(F.lit(1)).alias("_m"), F.sum(one).alias("_w"), F.max("_c").alias("_most"))
    ours = F.col("_e").isNotNull()
    clash = ours & ((F.col("_m") > 1) | F.col("Id_Employee").isNull() | F.col("EmployeeId").isNull())
    weights = grouped.select(*units, ours.alias("_ours"), F.when(ours, F.col("_w")).otherwise(0).alias("_w"), "_most", clash.alias("_clash"))
    placed = prefix_by_ranges(weights, units, "_w")
    seen = placed.agg(F.max("_most").alias("most"), F.count_if("_clash").alias("clashes")).first()
    return (None if seen["clashes"] else placed.filter("_ours").select(*units, "_before")), int(seen["most"] or 0)


def _join_hot_employees(e: DataFrame, hot: DataFrame, split) -> DataFrame:
    """Employees of hot keys joined to their (range-numbered) history.

    The employees of hot keys are few (one per key when the key is unique, as
    declared); when their measured count is small they are broadcast, so the
    hot rows are not shuffled again. Otherwise a sort-merge join whose skewed
    partitions AQE splits.
    """
    spark = e.sparkSession
    e_hot = keep(e.join(split.keys_side([K]), K, "left_semi"))
    limit = conf_int(spark, MAX_BROADCAST_ROWS, MAX_BROADCAST_ROWS_DEFAULT)
    side = F.broadcast(e_hot) if e_hot.count() <= limit else e_hot
    return hot.join(side, K, "inner")


def first_positions(hist: DataFrame, key_mode: str = EXACT, carry: list[str] | None = None) -> DataFrame:
    """Each key's first position (earliest start, nulls last, ties by smaller Id).

    ``carry`` limits the columns held in the aggregation buffer to those the
    caller outputs; Catalyst cannot prune fields inside an aggregate's buffer.
    """
    return first_per_group(_history_with_duration(hist, key_mode), [K], TRAINING_ORDER, carry=carry)


def training_fact(emp: DataFrame, hist: DataFrame, *, key_mode: str = EXACT, golden: bool = False) -> DataFrame:
    """(Id_Employee, Id_PositionHistory, training_day_duration) for ``rn = 1``.

    Same rows as filtering ``training_history`` on ``rn = 1``, but the first
    position comes from an aggregate, so no window and no full ordinal.
    ``golden=True`` types the two history columns as doubles, as the source
    job's fact carried them (their text form is then ``1.0``, ``58.0``).
    """
    e = _employee_for_training(emp, key_mode)
    first = first_positions(hist, key_mode, carry=["Id_PositionHistory", "training_day_duration"])
    fact = e.join(first, K, "inner").select(*TRAINING_FACT_COLUMNS)
    if golden:
        fact = fact.select(
            "Id_Employee",
            F.col("Id_PositionHistory").cast("double").alias("Id_PositionHistory"),
            F.col("training_day_duration").cast("double").alias("training_day_duration"),
        )
    return fact


def training_periods(emp: DataFrame, hist: DataFrame, *, key_mode: str = EXACT) -> DataFrame:
    """(EmployeeId, StartDate, EndDate, training_day_duration) of the first position."""
    e = _employee_for_training(emp, key_mode)
    first = first_positions(hist, key_mode, carry=["StartDate", "EndDate", "training_day_duration"])
    return e.join(first, K, "inner").select(*TRAINING_PERIOD_COLUMNS)


CSV_ORDER = ["Id_Employee", "EmployeeId", "rn", "Id_PositionHistory"]


def with_row_index(df: DataFrame, order: list[str] = CSV_ORDER, name: str = "row_index") -> DataFrame:
    """0-based row index over ``order`` (nulls last), as the first column.

    Computed by ranges (partition counts plus offsets), never by a
    single-partition window.
    """
    numbered = number_by_ranges(df, [], order, name=name, start=0)
    return numbered.select(name, *df.columns)


def dim_employee(emp: DataFrame, *, as_text: bool = False) -> DataFrame:
    """The employee dimension: typed by default, every column as text on request."""
    return stringify(emp) if as_text else emp


def validate_sources(emp: DataFrame, hist: DataFrame) -> DataFrame:
    """The declared constraints of both source tables, checked as Spark jobs.

    Parquet and CSV sources do not enforce what the source database declared;
    in particular the latest-position and training queries rank history per
    key before joining, which equals ranking after the join only while
    ``EmployeeId`` is unique among employees.
    """
    from tenure import schemas as S
    from tenure.operators.checks import declared_violations

    e = declared_violations(
        emp, S.EMPLOYEE_TABLE, primary_key=S.PRIMARY_KEYS[S.EMPLOYEE_TABLE], unique=S.UNIQUE_KEYS[S.EMPLOYEE_TABLE],
        not_null=S.not_null_columns(S.EMPLOYEE), lengths=S.VARCHAR_LIMITS[S.EMPLOYEE_TABLE],
    )
    h = declared_violations(
        hist, S.HISTORY_TABLE, primary_key=S.PRIMARY_KEYS[S.HISTORY_TABLE], unique=S.UNIQUE_KEYS[S.HISTORY_TABLE],
        not_null=S.not_null_columns(S.POSITION_HISTORY), lengths=S.VARCHAR_LIMITS[S.HISTORY_TABLE],
    )
    return e.unionByName(h)
