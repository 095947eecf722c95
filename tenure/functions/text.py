"""Text casts and the join key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXACT = "exact"
CASE_INSENSITIVE = "ci_rtrim"
KEY_MODES = (EXACT, CASE_INSENSITIVE)

# Name of the internal join-key column added to both sides of a join.
JOIN_KEY = "_k"


# Letters that upper case alone would treat wrongly: a dotless i must stay apart
# from a plain one, and the capital sharp s is already upper case.
DOTLESS_I, HELD = "\u0131", "\ue131"
CAPITAL_SHARP_S = "\u1e9e"


def fold_case(c: Column) -> Column:
    """Text with case taken out, as full case folding does.

    Lower case alone is not that: a sharp s is not the lower case of SS, a
    final sigma differs from the other one, and a long s keeps its form. (Of
    these, the sharp and the long s are variants of their own to a Unicode
    collation; folding makes them plain.) Upper
    and then lower case gives all of a letter's forms one text, independent of
    the language. (The step in between also keeps the optimiser from taking
    lower(upper(x)) for lower(x), which it is not.)
    """
    upper = F.upper(F.replace(F.translate(c, DOTLESS_I, HELD), F.lit(CAPITAL_SHARP_S), F.lit("SS")))
    return F.lower(F.translate(upper, HELD, DOTLESS_I))


def key_column(c: str | Column, mode: str = EXACT) -> Column:
    """Join key as text.

    ``exact`` compares the text as stored (the key is cast to string first, as
    the source job did before merging). ``ci_rtrim`` follows the source
    database collation: case-insensitive (full case folding, so ``STRASSE``
    meets ``Straße``; accents count) and blind to trailing blanks. The key
    is normalised once into a plain column, so the join stays a hash join that
    can broadcast or reuse partitioning; a collated comparison would not.
    """
    if mode not in KEY_MODES:
        raise ValueError(f"key mode must be one of {KEY_MODES}, got {mode!r}")
    col = F.col(c) if isinstance(c, str) else c
    col = col.cast("string")
    if mode == CASE_INSENSITIVE:
        col = fold_case(F.rtrim(col))
    return col


def with_join_key(df: DataFrame, key: str, mode: str = EXACT) -> DataFrame:
    return df.withColumn(JOIN_KEY, key_column(key, mode))


def stringify(df: DataFrame) -> DataFrame:
    """Every column cast to text, in place; nulls stay null (not 'None')."""
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])
