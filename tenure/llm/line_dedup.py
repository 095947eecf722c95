"""Repeated runs of lines, found by winnowing.

A document is its lines that hold a word, by a 128-bit code of each stripped
line. A run is a stretch of consecutive lines with at least ``min_words``
words; its code has 128 bits too (two rolling hashes of the two halves of its
lines' codes), so at 10^12 runs a false match has a chance of about 10^-15. A line is deleted if it lies in a run that also occurs at an earlier
place (documents in order of id, then lines in order); the earliest copy of
any line always stays.

Winnowing: the grams of a document are its shortest stretches of at least
GRAM_WORDS words from each line on; of the grams inside each shortest run the
one with the smallest code is a fingerprint. Two equal runs select the same
gram, so every repeated run holds a fingerprint that repeats: only documents
with a repeated fingerprint go on. Their shortest runs, taken from each line
forwards and from each line backwards, are matched with their first
occurrences; consecutive matches extend each other both ways to the whole
repeated stretch.

First occurrences are an aggregate with a partial step, and the join back is
on the run's code, which AQE splits when one run fills a large share of the
rows. No pairs of documents are formed.

Defined results: null text stays null, empty text stays empty; lines without a
word go only if lines around them in one deleted stretch go; rows with equal
id and text are one document and share the result; ids may be of any type, null
ids come last; an empty table gives an empty table; extra columns are passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.session import materialize

from .common import chunks, free_name, row_key, utf8

MIN_WORDS = 25
GRAM_WORDS = 8

_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, one for each half of a code
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0:1] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(text: bytes, min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS):
    """(anchors, both halves of the codes of shortest runs, their first line, their last line) of a text; line numbers from 0."""
    none = np.zeros(0, np.int64)
    number, words, code = [], [], bytearray()
    for k, line in enumerate(text.split(b"\n")):
        if n := len(line.split()):
            number.append(k)
            words.append(n)
            code += hashlib.blake2b(line.strip(), digest_size=16).digest()
    n = len(number)
    if sum(words) < min_words:
        return none, none, none, none, none
    number, upto = np.array(number), np.concatenate(([0], np.cumsum(words)))
    halves = np.frombuffer(bytes(code), "<u8").reshape(-1, 2).T
    sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _powers(b, n)))) for h, b in zip(halves, _BASES, strict=True)]
    back = [_powers(b, n) for b in _INVERSES]

    def code_of(first, last, half=0):  # the same stretch has the same code wherever it lies
        return _mix((sums[half][last + 1] - sums[half][first]) * back[half][first] + (last - first + 1).astype(np.uint64))

    starts = np.arange(n)
    ends = np.searchsorted(upto, upto[:-1] + min_words) - 1
    first, last = starts[ends < n], ends[ends < n]
    gram_end = np.searchsorted(upto, upto[:-1] + gram_words) - 1
    grams = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    whole = np.flatnonzero(gram_end < n)
    grams[whole] = code_of(whole, gram_end[whole])
    best = np.full(len(first), np.iinfo(np.uint64).max, np.uint64)
    for step in range(int((last - first).max()) + 1):
        at = np.minimum(first + step, n - 1)
        best = np.where((first + step <= last) & (gram_end[at] <= last), np.minimum(best, grams[at]), best)
    # from each line backwards: the last line at which at least min_words words remain
    begin = np.searchsorted(upto, upto[1:] - min_words, side="right") - 1
    lasts = starts[begin >= 0]
    begin = begin[begin >= 0]
    pairs = np.unique(np.concatenate((first * n + last, begin * n + lasts)))
    first, last = pairs // n, pairs % n
    return np.unique(best).view(np.int64), code_of(first, last).view(np.int64), code_of(first, last, 1).view(np.int64), number[first], number[last]


PRINTS = "anchors array<bigint>, runs array<struct<code:bigint,code2:bigint,first:int,last:int>>"


def kept_ranges(spans: list[dict]) -> list[dict]:
    """Complement of the union of line spans: (first line, number of lines), the last one open-ended."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: s["first"]):
        if s["first"] > at:
            out.append({"first": at, "n": s["first"] - at})
        at = max(at, s["last"] + 1)
    return [*out, {"first": at, "n": 2**30}]


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, gram_words: int = GRAM_WORDS) -> DataFrame:
    """(key, kept) of the documents with lines to delete: the ranges of lines that stay."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [pa.field("code", pa.int64()), pa.field("code2", pa.int64()), pa.field("first", pa.int32()), pa.field("last", pa.int32())]
        for batch in chunks(batches):
            anchors, columns = [], ([], [], [], [])
            for text in utf8(batch):
                found = fingerprints(text, min_words, gram_words)
                anchors.append(found[0])
                for column, part in zip(columns, found[1:], strict=True):
                    column.append(part)
            sizes = [len(c) for c in columns[0]]
            flat = pa.StructArray.from_arrays([pa.array(np.concatenate(c).astype(f.type.to_pandas_dtype())) for c, f in zip(columns, fields, strict=True)], fields=fields)
            runs = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(anchors, pa.list_(pa.int64())), runs], names=["key", "doc_id", "anchors", "runs"])

    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    rows = docs.where(text.isNotNull()).select(row_key(doc_id, text).alias("key"), doc_id.alias("doc_id"), text.cast("string").cast("binary").alias("text"))
    prints = materialize(rows.mapInArrow(scan, f"key string, doc_id {rows.schema['doc_id'].dataType.simpleString()}, {PRINTS}"), "prints")
    anchors = prints.select("key", F.explode("anchors").alias("anchor")).distinct()
    # written, so that the join deals both sides anew and AQE can split an anchor that very many documents hold
    shared = materialize(anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "shared")
    # a document that repeats itself shows it in its runs, not in its distinct anchors
    alone = prints.select("key", (F.size("runs") - F.size(F.array_distinct(F.col("runs.code")))).alias("twice")).where("twice > 0").select("key")
    keys = materialize(anchors.join(shared, "anchor").select("key").union(alone).distinct(), "suspects")
    runs = prints.join(keys, "key").select("key", "doc_id", F.explode("runs").alias("r")).select("key", "doc_id", "r.*").distinct()
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "first")
    code = ["code", "code2"]
    origin = runs.groupBy(*code).agg(F.min(place).alias("origin"), F.count(F.lit(1)).alias("n")).where("n > 1").select(*code, "origin")
    later = runs.join(origin, code).where(place > F.col("origin"))
    spans = later.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("n", pa.int32())]))
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([kept_ranges(s) for s in batch.column(1).to_pylist()], kind)], names=["key", "kept"])

    return spans.mapInArrow(rest, "key string, kept array<struct<first:int,n:int>>")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, drop_emptied: bool = False, counts: bool = False) -> DataFrame:
    """The documents with repeated runs deleted from their texts, other columns unchanged.

    ``drop_emptied`` leaves out documents that lost all their lines; ``counts``
    adds n_lines and n_removed.
    """
    found = materialize(repeated(docs, id_col, text_col, min_words), "repeats")
    key, kept, lines, new = (free_name(docs, x) for x in ("row_key", "kept_ranges", "all_lines", "new_text"))
    doc_id, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    # a merge join at every size: the texts are dealt by key once, whatever the number of repeats
    found = found.select(F.col("key").alias(key), F.col("kept").alias(kept)).hint("merge")
    joined = docs.withColumn(key, row_key(doc_id, text)).join(found, key, "left")
    joined = joined.withColumn(lines, F.when(F.col(kept).isNotNull() | F.lit(counts), F.split(text, "\n", -1)))
    stay = F.flatten(F.transform(kept, lambda r: F.slice(lines, r["first"] + 1, r["n"])))
    joined = joined.withColumn(new, F.when(F.col(kept).isNotNull(), stay))
    if drop_emptied:
        joined = joined.where(F.col(kept).isNull() | F.exists(new, lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]"))))
    out = [F.when(F.col(kept).isNotNull(), F.array_join(new, "\n")).otherwise(F.col(f"`{c}`")).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
        out += [n.alias("n_lines"), F.when(F.col(kept).isNotNull(), n - F.size(new)).otherwise(0).cast("long").alias("n_removed")]
    return joined.select(*out)
