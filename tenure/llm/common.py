"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of code points other than blank, tab, newline,
# vertical tab, form feed and carriage return. ``bytes.split()`` cuts at the
# same six bytes, so workers split UTF-8 bytes with it.
WORD = r"[^\x20\x09-\x0D]+"

#: Characters of text that a worker handles at once.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, want: str) -> str:
    """``want``, with underscores in front until ``df`` has no such column."""
    have = {c.lower() for c in df.columns}
    while want.lower() in have:
        want = "_" + want
    return want


def row_key(*cols: Column) -> Column:
    """A 128-bit key of a row's values that tells null from any text.

    Rows with the same key are the same document repeated: every operator
    gives them the same decision, so no row number is needed.
    """
    parts = [F.coalesce(F.concat(F.lit("v"), F.length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("n")) for c in cols]
    return F.md5(F.concat(*parts))


def held_out(doc_id: Column) -> Column:
    """True for the documents that no model may learn from (null ids: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text (one long text alone may be more)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.array([0 if s is None else s for s in pa.compute.binary_length(column).to_pylist()], dtype=np.int64)
        group = np.cumsum(sizes) // size
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def utf8(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [t or b"" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def as_binary(df: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` and the text as bytes, which workers split without decoding."""
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").cast("string").cast("binary").alias("text"))


class Numbered(dict):
    """Numbers words 0, 1, 2, ... as they first come."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n
