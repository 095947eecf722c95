"""Best-two-fit packing of token sequences.

Documents are tokenised in a map, cut into pieces of at most ``capacity``
tokens, and packed by piece length. Pieces are dealt by a hash to shards of
about ``shard_pieces`` pieces, from an exact count; a shard packs alone, which
costs at most about one partly filled sequence a shard, and a shard is small
whatever the table's size. Inside a shard only the counts of each length
matter. A sequence is filled greedily with the longest piece that fits; if a
gap stays, its smallest piece is taken out again when two unpacked pieces fit
the widened gap more tightly.

Token ids come from the tokenizer file ``tokenizer``. White space splits text
before its byte-pair merges, so each blank-separated word is tokenised once and
remembered; the ids are those of the whole text. Texts are split, numbered and
put together again as whole columns, never word by word.

Defined results: null text is empty; an empty text is its end id alone, one
piece of length 1; ids may be of any type and null; repeated rows are packed as
rows of their own, with equal digests; pieces of one length are dealt in the
order of id, piece and digest; extra columns are not read; an empty table gives
an empty table.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.session import materialize

from .common import as_binary, chunks

CAPACITY = 2048
END_ID = 0
SHARD_PIECES = 100_000
CACHE_WORDS = 500_000
CHUNK_BYTES = 2 << 20  # text whose words and ids are laid out at once
JOINED = 200  # words of letters that are tokenised as one text
WORD_END = "</w>"


class WordIds:
    """Ids of blank-separated words, each word tokenised once and numbered.

    A word of letters alone is one pre-token, and the last of its ids ends a
    word; so many of them are tokenised as one text, joined by blanks, and the
    ids are cut after those that end a word. Other words are tokenised alone.
    """

    def __init__(self, tokenizer: str, cache_words: int = CACHE_WORDS):
        self.most = cache_words
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task on each core already
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(tokenizer)
        self.encode = getattr(own, "encode_batch_fast", own.encode_batch)
        vocabulary = own.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[k for token, k in vocabulary.items() if token.endswith(WORD_END)]] = True
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.start, self.length = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _keep(self, words: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self.number), len(words)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        while n + m > len(self.start):
            self.start, self.length = (np.concatenate((x, np.zeros_like(x))) for x in (self.start, self.length))
        self.ids[self.used : self.used + len(flat)] = flat
        self.start[n : n + m] = self.used + np.cumsum(sizes) - sizes
        self.length[n : n + m] = sizes
        self.used += len(flat)
        self.number.update(zip(words, range(n, n + m), strict=True))

    def _alone(self, words: list[str]) -> None:
        coded = [c.ids for c in self.encode(words, add_special_tokens=False)]
        self._keep(words, np.fromiter(chain.from_iterable(coded), "<u4"), np.array([len(c) for c in coded], np.int64))

    def add(self, words: list[str]) -> None:
        letters = [w for w in words if w.isalpha()]
        joined = [letters[k : k + JOINED] for k in range(0, len(letters), JOINED)]
        for part, coded in zip(joined, self.encode([" ".join(p) for p in joined], add_special_tokens=False), strict=True):
            flat = np.array(coded.ids, "<u4")
            last = np.flatnonzero(self.ends[flat])
            if len(last) == len(part) and last[-1] == len(flat) - 1:
                self._keep(part, flat, np.diff(last, prepend=-1))
            else:  # a word that the tokenizer takes apart after all
                self._alone(part)
        others = [w for w in words if not w.isalpha()]
        if others:
            self._alone(others)

    def numbers(self, words: list[str]) -> np.ndarray:
        """The numbers of different words; new ones are tokenised first."""
        if len(self.number) > self.most:
            self.clear()
        found = list(map(self.number.get, words))
        new = [k for k, n in enumerate(found) if n is None]
        if new:
            self.add([words[k] for k in new])
            for k in new:
                found[k] = self.number[words[k]]
        return np.array(found, np.int64)


def _plain(texts: pa.Array) -> pa.Array:
    """Texts with the same ids and fewer different words: A-Z lower-cased, a last full stop or comma apart.

    The tokenizer lower-cases and cuts between letters and other characters
    itself. Texts that might hold a special token's name stay as they are.
    """
    lower = pc.replace_substring_regex(pc.ascii_lower(texts), r"([a-z])([.,])([\x20\x09-\x0D]|$)", r"\1 \2\3")
    return pc.if_else(pc.match_substring(texts, "<|"), texts, lower)


def token_ids(texts: pa.Array, known: WordIds, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids one after the other, each text's end id last, and where each text ends."""
    lists = pc.ascii_split_whitespace(_plain(texts))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    word = known.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy(zero_copy_only=False)] if len(coded) else np.zeros(0, np.int64)
    after = np.cumsum(sizes)
    # the end id is a word of its own behind every text
    length = np.insert(known.length[word], after, 1)
    start = np.insert(known.start[word], after, -1)
    stop = np.cumsum(length)
    ids = known.ids[np.repeat(start - (stop - length), length) + np.arange(stop[-1] if len(stop) else 0)]
    ends = stop[after + np.arange(len(after))]
    ids[ends - 1] = end_id
    return ids, ends


def _texts(batch: pa.RecordBatch) -> pa.Array:
    """A batch's texts; null is empty, bytes that are no UTF-8 are replaced."""
    column = batch.column(batch.schema.get_field_index("text"))
    try:
        return pc.fill_null(column.cast(pa.string()), "")
    except pa.ArrowInvalid:
        return pa.array([(t or b"").decode("utf-8", "replace") for t in column.to_pylist()], pa.string())


PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"


def _with_id(df: DataFrame, id_col: str, columns: str) -> str:
    """Columns behind the id, which keeps its own type."""
    return f"doc_id {df.schema[id_col].dataType.simpleString()}, {columns}"


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    cache_words: int = CACHE_WORDS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """One row per piece; ``with_ids`` adds the ids themselves (array of int).

    ``cache_words`` and ``chunk_bytes`` bound what a worker holds besides its batch.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(tokenizer, cache_words)
        for batch in chunks(batches, size=chunk_bytes):
            flat, ends = token_ids(_texts(batch), words)
            size = np.diff(ends, prepend=0)
            n = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            at = (ends - size)[row] + start
            raw = memoryview(flat).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
            out = [batch.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:  # the pieces follow one another without a gap
                ids = pa.ListArray.from_arrays(pa.array(np.append(at, ends[-1:]).astype(np.int32)), pa.array(flat.astype(np.int32)))
                out, names = [*out, ids], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return as_binary(docs, id_col, text=text_col).mapInArrow(cut, _with_id(docs, id_col, PIECES + (", ids array<int>" if with_ids else "")))


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Lengths of the pieces in each sequence, for pieces shorter than the capacity."""
    count = np.bincount(lengths, minlength=capacity + 1)
    size = np.arange(capacity + 1)
    below = np.maximum.accumulate(np.where(count > 0, size, 0))  # longest unpacked length up to each

    def take(x: int) -> None:
        count[x] -= 1
        if not count[x]:
            stop = x + 1
            while stop <= capacity and below[stop] == x:
                stop += 64
            stop = min(stop, capacity + 1)
            part = below[x:stop]
            part[part == x] = below[x - 1]

    def put(x: int) -> None:
        count[x] += 1
        part = below[x:]
        stop = int(np.searchsorted(part, x, side="left"))
        part[:stop] = x

    out = []
    while longest := int(below[capacity]):
        bin_, gap = [longest], capacity - longest
        take(longest)
        while gap and (x := int(below[gap])):
            bin_.append(x)
            gap -= x
            take(x)
        if gap and len(bin_) > 1 or gap and below[capacity]:
            small = min(bin_)
            room = gap + small
            first = np.flatnonzero(count[: room // 2 + 1])
            if len(first):
                second = below[room - first]
                # the second is at least as long as the first; two of one length need two pieces
                fits = (second > first) | (second == first) & (count[first] > 1)
                total = np.where(fits, first + second, 0)
                best = int(total.argmax())
                if total[best] > small:
                    a, b = int(first[best]), int(second[best])
                    take(a)
                    take(b)
                    bin_.remove(small)
                    bin_ += [a, b]
                    put(small)
        out.append(bin_)
    return out


PLACED = PIECES + ", sequence_id bigint, offset bigint"


def _pack_shard(part: pd.DataFrame, capacity: int) -> pd.DataFrame:
    part = part.sort_values(["length", "doc_id", "piece", "ids_crc32"], kind="stable").reset_index(drop=True)
    length = part["length"].to_numpy()
    full = length == capacity
    sequence, offset = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
    sequence[full] = np.arange(full.sum())
    n = int(full.sum())
    # the rows of each length lie together; each use takes the next of them
    free = np.searchsorted(length, np.arange(capacity + 2)).tolist()
    rows, ids, offsets = [], [], []
    for k, bin_ in enumerate(best_two_fit(length[~full], capacity)):
        at = 0
        for x in bin_:
            rows.append(free[x])
            free[x] += 1
            ids.append(n + k)
            offsets.append(at)
            at += x
    sequence[rows], offset[rows] = ids, offsets
    part["sequence_id"] = sequence + (part["shard"].to_numpy().astype(np.int64) << 24)
    part["offset"] = offset
    return part.drop(columns="shard")


def pack(cut: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The rows of ``pieces`` with sequence_id and offset. Lengths are 1 to ``capacity``."""
    # the salt is written with the pieces, so a task run again deals its rows alike; it spreads rows that repeat
    salted = cut.select("doc_id", "piece", "start", "length", "ids_crc32", F.monotonically_increasing_id().alias("salt"))
    cut = materialize(salted, "pieces")
    shards = max(1, -(-cut.count() // shard_pieces))
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "salt"), F.lit(shards))

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        return _pack_shard(part, capacity)

    return cut.withColumn("shard", shard).drop("salt").groupBy("shard").applyInPandas(fill, _with_id(cut, "doc_id", PLACED))


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    id_col: str = "doc_id",
    text_col: str = "text",
    cache_words: int = CACHE_WORDS,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its place."""
    return pack(pieces(docs, tokenizer, capacity, id_col, text_col, False, cache_words, chunk_bytes), capacity)


def sequences(docs: DataFrame, placed: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (array of int), for unique doc_ids.

    Joins the ids to their places and lays them side by side, one sequence of
    at most ``capacity`` ids at a time.
    """
    ids = pieces(docs, tokenizer, capacity, id_col, text_col, with_ids=True).select("doc_id", "piece", "ids")
    rows = placed.select("doc_id", "piece", "sequence_id", "offset").join(ids, ["doc_id", "piece"])
    parts = rows.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
