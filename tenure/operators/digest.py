"""An order-free digest of a set of rows: equal sets of rows, equal digest.

Each row becomes a text (its values with their lengths, so no two rows share
one by accident), the text an MD5 sum, and the first and second 60 bits of the
sum whole numbers. The digest is the sum of the first and the exclusive or of
the second over all rows. Both are plain aggregates with a partial step, so
they ride along a write as an ``Observation``; any engine with MD5 can repeat
them. A changed, lost or repeated row changes the sum; rows in another order
or in other files do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

HALF = 15  # hexadecimal digits, 60 bits


def value_text(c: Column, kind: T.DataType) -> Column:
    """``n`` for null, else ``<characters>:<text>``; text as Spark casts it, bytes in hexadecimal."""
    text = F.hex(c) if isinstance(kind, T.BinaryType) else F.to_json(F.struct(c)) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))


def row_text(df: DataFrame) -> Column:
    """All values in the order of the columns' names (a partitioned table moves columns about)."""
    return F.concat(*[value_text(F.col(f"`{f.name}`"), f.dataType) for f in sorted(df.schema, key=lambda f: f.name)])


def _half(md5: Column, start: int) -> Column:
    return F.conv(F.substring(md5, start, HALF), 16, 10).cast("bigint")


def digest_aggregates(df: DataFrame) -> list[Column]:
    """The digest's two aggregates over ``df``, to be observed or selected."""
    md5 = F.md5(row_text(df).cast("binary"))
    return [F.sum(_half(md5, 1).cast("decimal(38,0)")).alias("digest_sum"), F.bit_xor(_half(md5, HALF + 1)).alias("digest_xor")]


def digest_text(measured: dict | Row) -> str:
    """``<sum>-<xor>``; no rows give ``0-0``."""
    return f"{int(measured['digest_sum'] or 0)}-{int(measured['digest_xor'] or 0)}"


def content_digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of a frame, in one pass."""
    got = df.agg(F.count(F.lit(1)).alias("rows"), *digest_aggregates(df)).first()
    return int(got["rows"]), digest_text(got)
