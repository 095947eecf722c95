"""Declared constraints as checking jobs.

Parquet tables do not enforce keys, nullability or lengths, so each check
returns what violates it: offending keys, or one row of counts per column.
Every check is one scan with a partial aggregate.

``declared_violations`` takes all constraints of a table together, in one scan
and one shuffle: a row gives one entry per key (the constraint's number and a
128-bit hash of the key) and one per null or over-long value it holds (the
constraint's number alone, so these collapse before the shuffle). Entries are
counted, and the counts summed by constraint. Only where a hash came twice are
the keys themselves compared, those rows alone, so the answer does not rest on
the hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str], *, allow_null: bool = False) -> DataFrame:
    """Key values that occur more than once, or (unless ``allow_null``) hold a null.

    Output: the key columns and ``n_rows``. Empty means the key holds, as a
    primary key (``allow_null=False``) or a unique constraint.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = F.col("n_rows") > 1
    if not allow_null:
        for k in keys:
            bad = bad | F.col(k).isNull()
    return counted.filter(bad)


def null_counts(df: DataFrame, columns: list[str], table: str | None = None) -> DataFrame:
    """Rows holding a null, per column: ``column_name``, ``null_rows``.

    All columns are counted in one pass (one partial aggregate), then turned
    into one row per column.
    """
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    out = counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, null_rows)")
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


def length_violations(df: DataFrame, limits: dict[str, int], table: str | None = None) -> DataFrame:
    """Per text column: ``column_name``, ``max_length``, ``length_limit``, ``too_long``.

    ``too_long`` counts values longer than the declared ``VARCHAR(n)``; lengths
    are in characters. One pass for all columns.
    """
    cols = [c for c in limits if c in df.columns]
    aggs = []
    for c in cols:
        aggs.append(F.max(F.length(F.col(c))).alias(f"{c}__max"))
        aggs.append(F.count_if(F.length(F.col(c)) > F.lit(limits[c])).alias(f"{c}__bad"))
    wide = df.agg(*aggs)
    rows = ", ".join(f"'{c}', `{c}__max`, {limits[c]}, `{c}__bad`" for c in cols)
    out = wide.selectExpr(f"stack({len(cols)}, {rows}) as (column_name, max_length, length_limit, too_long)")
    if table is not None:
        out = out.select(F.lit(table).alias("table_name"), "*")
    return out


@dataclass(frozen=True)
class Constraint:
    """One declared constraint: ``check`` is primary_key, unique, not_null or max_length."""

    check: str
    columns: tuple[str, ...]
    limit: int | None = None

    @property
    def is_key(self) -> bool:
        return self.check in ("primary_key", "unique")

    def broken(self) -> Column:
        """True where a row breaks a null or length constraint."""
        c = F.col(f"`{self.columns[0]}`")
        return c.isNull() if self.check == "not_null" else F.coalesce(F.length(c.cast("string")) > self.limit, F.lit(False))


def declared_constraints(
    columns: list[str],
    *,
    primary_key: list[str] | None = None,
    unique: list[list[str]] | None = None,
    not_null: list[str] | None = None,
    lengths: dict[str, int] | None = None,
) -> list[Constraint]:
    """The declared constraints of the columns that a frame carries."""
    have = set(columns)
    keys = [("primary_key", primary_key or [])] + [("unique", k) for k in unique or []]
    out = [Constraint(check, tuple(k)) for check, k in keys if k and set(k) <= have]
    out += [Constraint("not_null", (c,)) for c in not_null or [] if c in have]
    return out + [Constraint("max_length", (c,), n) for c, n in (lengths or {}).items() if c in have]


def _key_hash(columns: tuple[str, ...], seed: int) -> Column:
    # null flags are hashed too: the hash of a null is that of nothing
    cols = [F.col(f"`{c}`") for c in columns]
    return F.xxhash64(F.lit(seed), *cols, *[c.isNull() for c in cols])


def constraint_entries(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """(c, h1, h2, holds_null, n): how often each key, or break of a constraint, occurs; one scan, one shuffle."""
    entries = []
    for i, c in enumerate(constraints):
        if c.is_key:
            null = F.lit(False)
            for k in c.columns:
                null = null | F.col(f"`{k}`").isNull()
            parts = F.lit(i), _key_hash(c.columns, 1), _key_hash(c.columns, 2), null
            entries.append(F.struct(*[p.alias(n) for p, n in zip(parts, ("c", "h1", "h2", "holds_null"), strict=True)]))
        else:
            none = F.lit(None).cast("bigint")
            entry = F.struct(F.lit(i).alias("c"), none.alias("h1"), none.alias("h2"), F.lit(False).alias("holds_null"))
            entries.append(F.when(c.broken(), entry))
    exploded = df.select(F.explode(F.array(*entries)).alias("e")).filter(F.col("e").isNotNull()).select("e.*")
    return exploded.groupBy("c", "h1", "h2", "holds_null").agg(F.count(F.lit(1)).alias("n"))


def _exact_key_violations(df: DataFrame, constraint: Constraint, suspects: DataFrame) -> int:
    """Offending keys among the rows whose hash came twice or whose key holds a null."""
    keys = list(constraint.columns)
    rows = df.select(*keys).withColumns({"_h1": _key_hash(constraint.columns, 1), "_h2": _key_hash(constraint.columns, 2)})
    side = suspects.select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"))
    bad = duplicate_keys(rows.join(side, ["_h1", "_h2"], "left_semi"), keys, allow_null=constraint.check == "unique")
    return bad.count()


def declared_violations(
    df: DataFrame,
    table: str,
    *,
    primary_key: list[str] | None = None,
    unique: list[list[str]] | None = None,
    not_null: list[str] | None = None,
    lengths: dict[str, int] | None = None,
) -> DataFrame:
    """Every declared constraint of one table as rows of
    (``table_name``, ``check_name``, ``column_name``, ``violations``).

    Keys count offending key values (repeated or null); ``not_null`` counts
    null rows; ``max_length`` counts over-long values. Only the columns the
    frame carries are checked. The job runs here: one number per constraint
    comes back.
    """
    constraints = declared_constraints(df.columns, primary_key=primary_key, unique=unique, not_null=not_null, lengths=lengths)
    schema = "table_name string, check_name string, column_name string, violations bigint"
    if not constraints:
        return df.sparkSession.createDataFrame([], schema)
    counted = constraint_entries(df, constraints)
    hashed = F.col("h1").isNotNull()
    per = counted.groupBy("c").agg(
        F.sum(F.when(~hashed, F.col("n"))).alias("broken"),
        F.count_if(hashed & ((F.col("n") > 1) | F.col("holds_null"))).alias("suspects"),
    )
    found = {r["c"]: r for r in per.collect()}  # a row per constraint
    out = []
    for i, c in enumerate(constraints):
        r = found.get(i)
        n = (r["broken"] or 0) if r else 0
        if c.is_key and r and r["suspects"]:
            suspects = counted.filter((F.col("c") == i) & hashed & ((F.col("n") > 1) | F.col("holds_null")))
            n = _exact_key_violations(df, c, suspects)
        out.append((table, c.check, ",".join(c.columns), int(n)))
    return df.sparkSession.createDataFrame(out, schema)
