"""Whitened embeddings from an exact, bit-sliced scatter matrix.

Each entry c becomes the whole number x = floor(64 c) + 1,000,000; the
fit list is every distinct x vector once. Its cross-products are taken by bit
planes: in each block of rows a dimension's values, shifted to start at 0, are
cut into bit planes, each plane is packed across the rows into 64-bit words,
and sum(x_i x_j) is the sum over pairs of planes of 2^(a+b) times the bits set
in their AND. All of it is whole numbers, added up by Spark as decimals, so the
scatter is exact whatever the order of tasks. It is centred as whole numbers
(n P - S S') and only then divided and given to ``eigh``.

The added 1,000,000 shifts no covariance, so sums are kept of floor(64 c).
The driver sees one row per pair of dimensions, never rows of the table.

Defined results: rows with a null vector, a null or a non-finite entry are
left out; zero and empty vectors are vectors (an empty one has no component);
entries beyond +-2^46 are an error, as their x would not be exact; vectors of
different lengths are spaces of their own, each fitted on its own fit list (a
matrix per length comes to the driver); repeated rows and ids each give their
rows but count once in the fit; a null id stays null. A component whose
eigenvalue is zero to rounding (below 1e-12 of the largest) has no whitened
value: null there, and it is left out of identity_error. ``deviation`` is null
where it needs more than 64 bits; ``deviation_text`` always has it in full. An
empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.session import materialize

# The scale of entries and the number of components returned.
SCALE = 64
COMPONENTS = 16

LARGEST = float(1 << 46)
#: Rows whose planes are packed at once (whole words of 64 rows).
BLOCK = 1 << 15
#: Pairs of planes are counted for so many planes on one side at once.
SIDE = 64
NO_EIGENVALUE = 1e-12


def scaled(values: np.ndarray) -> np.ndarray:
    """floor(64 c) of doubles, as whole numbers (x less its 1,000,000)."""
    if values.size and np.abs(values).max() > LARGEST:
        raise ValueError("an embedding's entry is too large for an exact whole number")
    return np.floor(values * SCALE).astype(np.int64)


def bit_planes(u: np.ndarray, bits: int) -> np.ndarray:
    """(dimension, plane, word) of whole numbers u >= 0 given as (row, dimension)."""
    rows = -(-len(u) // 64) * 64
    out = np.empty((u.shape[1], bits, rows // 64), np.uint64)
    plane = np.zeros((u.shape[1], rows), np.uint8)
    for b in range(bits):
        plane[:, : len(u)] = (u.T >> b) & 1
        out[:, b] = np.packbits(plane, axis=1, bitorder="little").view(np.uint64)
    return out


def scatter(y: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Exact sums and cross-products (upper triangle by rows) of a block of whole numbers."""
    n, d = y.shape
    low = y.min(0)
    u = y - low
    bits = max(1, int(u.max()).bit_length())
    planes = bit_planes(u, bits).reshape(d * bits, -1)
    weight = 1 << np.arange(bits, dtype=np.int64)
    wide = 2 * bits + n.bit_length() > 62
    ones = np.bitwise_count(planes).sum(1, dtype=np.int64).reshape(d, bits)
    if wide:  # beyond 62 bits sums go on as Python's whole numbers
        weight, ones, low = weight.astype(object), ones.astype(object), low.astype(object)
    sums = (ones * weight).sum(1)
    products = []
    per = max(1, SIDE // bits)
    for i in range(0, d, per):
        left = planes[i * bits : (i + per) * bits]
        both = np.empty((len(left), len(planes) - i * bits), np.int64)
        for k, plane in enumerate(left):
            both[k] = np.bitwise_count(plane & planes[i * bits :]).sum(1, dtype=np.int64)
        both = both.reshape(len(left) // bits, bits, d - i, bits)
        if wide:
            both = both.astype(object)
        part = ((both * weight).sum(3) * weight[None, :, None]).sum(1)
        products += [part[k, k:] for k in range(len(part))]
    low = [int(v) for v in low]
    sums = [int(v) for v in sums]
    full = []
    for i in range(d):  # back from the shifted values
        row = products[i].tolist()
        full.append([int(row[j - i]) + low[i] * sums[j] + low[j] * sums[i] + n * low[i] * low[j] for j in range(i, d)])
    return [s + n * v for s, v in zip(sums, low, strict=True)], full


def _pack(y: np.ndarray) -> bytes:
    """One form per vector: the narrowest of four widths that holds all entries, its name first."""
    for code in ("i1", "i2", "i4", "i8"):
        info = np.iinfo(code)
        if not len(y) or (y.min() >= info.min and y.max() <= info.max):
            return code.encode() + y.astype("<" + code).tobytes()
    raise AssertionError


def _unpack(packed: list[bytes], d: int) -> np.ndarray:
    by_form: dict[bytes, list[bytes]] = {}
    for p in packed:
        by_form.setdefault(p[:2], []).append(p[2:])
    return np.concatenate([np.frombuffer(b"".join(rows), "<" + form.decode()).reshape(-1, d).astype(np.int64) for form, rows in by_form.items()])


def _by_length(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, doubles) of a batch's vectors, which have no nulls."""
    lists = batch.column(batch.schema.get_field_index(column))
    lengths = np.asarray(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield int(d), rows, flat[starts[rows][:, None] + np.arange(d)]


def fit_list(vectors: DataFrame) -> DataFrame:
    """(d, y): every distinct scaled vector once, packed; ``vectors`` has a column v."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, _, values in _by_length(batch, "v"):
                y = np.unique(scaled(values), axis=0)
                packed = [_pack(row) for row in y]
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(y), pa.int32()), pa.array(packed, pa.binary())], names=["d", "y"])

    return vectors.select("v").mapInArrow(pack, "d int, y binary").distinct()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """The packed vectors of a task in blocks of one length."""
    held: dict[int, list[bytes]] = {}
    for batch in batches:
        for d, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if not d:
                continue
            rows = held.setdefault(d, [])
            rows.append(y)
            if len(rows) >= BLOCK:
                yield d, _unpack(held.pop(d), d)
    for d, rows in held.items():
        yield d, _unpack(rows, d)


def exact_scatter(fit: DataFrame) -> DataFrame:
    """(d, i, j, total): j = i.. cross-products; i = -1 sums; i = j = -2 the number of vectors."""
    whole = pa.decimal128(38, 0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        held: dict[int, list] = {}
        for d, y in _blocks(batches):
            s, p = scatter(y)
            old = held.get(d)
            if old is None:
                held[d] = [len(y), s, p]
            else:
                old[0] += len(y)
                old[1] = [a + b for a, b in zip(old[1], s, strict=True)]
                old[2] = [[a + b for a, b in zip(q, r, strict=True)] for q, r in zip(old[2], p, strict=True)]
        for d, (n, s, p) in held.items():
            i = [-2, *[-1] * d, *[k for k in range(d) for _ in range(k, d)]]
            j = [-2, *range(d), *[m for k in range(d) for m in range(k, d)]]
            total = [n, *s, *[v for row in p for v in row]]
            columns = [pa.array([d] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(v) for v in total], whole)]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "i", "j", "total"])

    return fit.mapInArrow(sums, "d int, i int, j int, total decimal(38,0)").groupBy("d", "i", "j").agg(F.sum("total").alias("total"))


class Space:
    """The whitening of vectors of one length."""

    def __init__(self, n: int, sums: list[int], products: dict[tuple[int, int], int]):
        d = len(sums)
        self.n, self.sums = n, sums
        v = np.empty((d, d))
        trace = Fraction(0)
        for i in range(d):
            for j in range(i, d):
                centred = n * products[i, j] - sums[i] * sums[j]
                v[i, j] = v[j, i] = centred / (n * n)  # whole numbers divide to the nearest double
            trace += Fraction(n * products[i, i] - sums[i] * sums[i], n * n)
        e, vectors = np.linalg.eigh(v)
        keep = np.arange(d)[::-1][:COMPONENTS]
        e, vectors = e[keep], vectors[:, keep]
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(len(e))] < 0, -1.0, 1.0)
        self.usable = (e > NO_EIGENVALUE * e.max(initial=0)) & (e > 0)
        self.project = vectors / np.where(self.usable, np.sqrt(np.abs(e)), 1.0)
        self.explained = np.array([float(Fraction(x) / trace) if trace else np.nan for x in e])
        self.identity_error = np.nan

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n y - S in whole numbers; Python's where 64 bits do not do."""
        most = max((abs(int(v)) for v in (y.min(initial=0), y.max(initial=0))), default=0)
        if self.n * most + max(map(abs, self.sums), default=0) >= 1 << 62:
            return self.n * y.astype(object) - np.array(self.sums, object)
        return self.n * y - np.array(self.sums, np.int64)

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        return (centred.astype(np.float64) / self.n) @ self.project

    def deviation(self, centred: np.ndarray) -> list[int]:
        if centred.dtype != object and centred.size:
            most = int(max(centred.max(), -centred.min()))
            if centred.shape[1] * most * most < 1 << 62:
                return (centred * centred).sum(1).tolist()
        return [sum(v * v for v in row) for row in centred.tolist()]


def learn(vectors: DataFrame) -> dict[int, Space]:
    """A ``Space`` per length of vector; ``vectors`` has a column v without nulls."""
    fit = materialize(fit_list(vectors), "fit-list")
    found: dict[int, dict] = {}
    for d, i, j, total in exact_scatter(fit).collect():  # a row per pair of dimensions
        found.setdefault(d, {})[i, j] = int(total)
    spaces = {}
    for d, total in found.items():
        spaces[d] = Space(total[-2, -2], [total[-1, k] for k in range(d)], total)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for d, y in _blocks(batches):
            w = spaces[d].whitened(spaces[d].centred(y))
            held[d] = held.get(d, 0) + np.concatenate((w.sum(0), (w.T @ w).ravel()))
        for d, total in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d] * len(total), pa.int32()), pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["d", "k", "total"])

    measured = fit.mapInArrow(products, "d int, k int, total double").groupBy("d", "k").agg(F.sum("total").alias("total"))
    entries: dict[int, dict] = {}
    for d, k, total in measured.collect():  # a row per pair of components
        entries.setdefault(d, {})[k] = total
    for d, total in entries.items():
        space = spaces[d]
        r, ok = len(space.usable), np.flatnonzero(space.usable)
        values = np.array([total[k] for k in range(r + r * r)]) / space.n
        covariance = values[r:].reshape(r, r) - np.outer(values[:r], values[:r])
        if len(ok):
            space.identity_error = float(np.abs(covariance[np.ix_(ok, ok)] - np.eye(len(ok))).max())
    return spaces


def whitened(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text; see the module."""
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False))))
    spaces = learn(rows)
    schema = T.StructType([T.StructField("vec_id", rows.schema["vec_id"].dataType), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
                           T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()),
                           T.StructField("identity_error", T.DoubleType()), T.StructField("deviation_text", T.StringType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, at, values in _by_length(batch, "v"):
                if not d:
                    continue
                space = spaces[d]
                centred = space.centred(scaled(values))
                w, r = space.whitened(centred), len(space.usable)
                deviation = space.deviation(centred)
                small = pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64())
                each = pa.array(np.repeat(np.arange(len(at)), r))
                usable = np.tile(space.usable, len(at))
                columns = [
                    batch.column(0).take(pa.array(np.repeat(at, r))),
                    pa.array(np.tile(np.arange(1, r + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * r, space.n, np.int64)),
                    small.take(each),
                    pa.array(w.ravel(), mask=~usable),
                    pa.array(np.tile(space.explained, len(at)), from_pandas=True),
                    pa.array(np.full(len(at) * r, space.identity_error), from_pandas=True),
                    pa.array([str(v) for v in deviation], pa.string()).take(each),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(place, schema)
