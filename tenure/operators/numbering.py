"""Surrogate ids in the manner of ``IDENTITY(seed, 1)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.operators.ranking import number_by_ranges


def assign_identity(df: DataFrame, column: str, order: list[str], *, seed: int = 0, first: int | None = None) -> DataFrame:
    """Fill missing ids in ``column``; explicit ids win.

    Rows that carry an id keep it (as with an explicit identity insert); the
    others are numbered in ``order`` (nulls last) after the greatest explicit id,
    or from ``seed`` when there is none, so new ids never collide with given
    ones. Ties in ``order`` are broken by the other columns, so equal inputs get
    equal ids and many rows of one order value spread over many ranges. The greatest id is a scalar subquery and the numbering goes by
    ranges, so nothing is collected and no task sees all rows. ``first`` is
    where the new ids start instead, from a leased block (see
    ``tenure.sinks.identity``, which never gives an id twice across loads).
    """
    given = df.filter(F.col(column).isNotNull())
    missing = df.filter(F.col(column).isNull()).drop(column)
    top = given.agg(F.max(column).alias("m")).scalar()
    start = F.lit(first) if first is not None else F.coalesce(top + F.lit(1), F.lit(seed))
    # maps have no order; rows equal in all that can be ordered may swap ids
    tail = [f.name for f in missing.schema if f.name not in order and "map<" not in f.dataType.simpleString()]
    numbered = number_by_ranges(missing, [], [*order, *tail], name="_ix", start=0)
    typ = df.schema[column].dataType
    filled = numbered.withColumn(column, (start + F.col("_ix")).cast(typ)).drop("_ix")
    return given.unionByName(filled.select(*df.columns))
