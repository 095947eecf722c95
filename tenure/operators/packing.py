"""Several columns as one whole number that sorts as they do, and back.

An aggregate whose buffer is a struct makes Spark sort its input; one whose
buffer is a long or a decimal is hashed. So dates, timestamps and whole numbers
are packed, each as a code of fixed width in decimal digits, into one bigint
(up to 18 digits) or decimal(38,0). The first column counts most. Nulls come
last: after all values ascending, before all values where the greatest is
taken first. Values outside a type's declared range raise, none is cut.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG_DIGITS, DECIMAL_DIGITS = 18, 38

# Days and microseconds from 0001-01-01 to 1970-01-01, and the
# least codes of whole numbers; dates run from year 1 to year 9999.
DAYS_TO_1970 = 719_162
MICROS_TO_1970 = DAYS_TO_1970 * 86_400_000_000


@dataclass(frozen=True)
class Code:
    """How one type becomes a code: ``value + shift``, from 0 to ``most``."""

    digits: int
    shift: int
    most: int


_WHOLE = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def code_of(kind: T.DataType) -> Code | None:
    if isinstance(kind, T.DateType):
        return Code(7, DAYS_TO_1970, 3_652_058)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return Code(18, MICROS_TO_1970, 3_652_059 * 86_400_000_000 - 1)
    bits = _WHOLE.get(type(kind))
    return Code(len(str(1 << bits)), 1 << (bits - 1), (1 << bits) - 1) if bits else None


def _as_number(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return F.unix_micros(c) if isinstance(kind, T.TimestampType) else c


def _from_number(n: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(n.cast("int"))
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", n.cast("bigint"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.timestamp_micros(n.cast("bigint")) if isinstance(kind, T.TimestampType) else n.cast(kind)


@dataclass(frozen=True)
class Packing:
    """Columns (name, type) packed together."""

    fields: tuple[tuple[str, T.DataType], ...]
    nulls_least: bool = False  # for orders of which the greatest comes first

    @property
    def digits(self) -> int:
        return sum(code_of(kind).digits for _, kind in self.fields)

    def pack(self) -> Column:
        wide = "bigint" if self.digits <= LONG_DIGITS else "decimal(38,0)"

        def number(n: int) -> Column:
            return F.lit(str(n)).cast(wide)

        packed, behind = None, 0
        for name, kind in reversed(self.fields):
            code = code_of(kind)
            value = _as_number(F.col(f"`{name}`"), kind).cast(wide) + number(code.shift)
            if not isinstance(kind, tuple(_WHOLE)):
                wrong = F.raise_error(F.lit(f"{name} is outside the years 1 to 9999")).cast(wide)
                value = F.when(value.between(number(0), number(code.most)), value).otherwise(wrong)
            null = number(0) if self.nulls_least else number(code.most + 1)
            value = F.when(F.col(f"`{name}`").isNull(), null).otherwise(value + number(1) if self.nulls_least else value)
            value = (value * number(10**behind)).cast(wide) if behind else value.cast(wide)
            packed = value if packed is None else (packed + value).cast(wide)
            behind += code.digits
        return packed

    def unpack(self, packed: Column) -> list[Column]:
        """The columns again (a group's one row is taken apart as text: exact at any width)."""
        text, at, out = F.lpad(packed.cast("string"), self.digits, "0"), 1, []
        for name, kind in self.fields:
            code = code_of(kind)
            value = F.substring(text, at, code.digits).cast("decimal(21,0)")
            null = F.lit(str(0 if self.nulls_least else code.most + 1)).cast("decimal(21,0)")
            shift = F.lit(str(code.shift + self.nulls_least)).cast("decimal(21,0)")
            number = F.when(value != null, value - shift).cast("bigint")
            out.append(_from_number(number, kind).alias(name))
            at += code.digits
        return out


def packing_of(df: DataFrame, columns: list[str], *, nulls_least: bool = False) -> Packing | None:
    """How to pack these columns of a frame; None if a type has no code or they are too wide together."""
    kinds = {f.name: f.dataType for f in df.schema}
    if not columns or any(c not in kinds or code_of(kinds[c]) is None for c in columns):
        return None
    made = Packing(tuple((c, kinds[c]) for c in columns), nulls_least)
    return made if made.digits <= DECIMAL_DIGITS else None
