"""Nearest vectors by inner product, found by cross-polytope hashing.

Vectors are rotated by pseudo-rotations (three times: random signs, then a fast
Hadamard transform) and hashed to the nearest signed axis. A bucket is one
signed axis of each of several rotations, so buckets keep holding about
BUCKET_ROWS vectors however many there are. Each of TABLES tables has
rotations of its own. A query probes, in every table, the buckets whose axes
lie nearest to it; the vectors of these buckets are its candidates, and their
inner products are taken in double precision from the original vectors.

How many buckets a query probes is measured, not set: for a bounded sample of
queries the true neighbours are found in one pass over all vectors, and the
probes are as many as find GOAL of them; if more than MAX_PROBES would be
needed, buckets are made larger. Inner products are turned into angles by one
more coordinate, per band of norms, when norms differ.

Rows, not parts of them, decide what is dealt where: equal vectors are one
class that keeps its 21 smallest ids (no more can be in an answer); a crowded
bucket is dealt out as pairs of blocks of vectors and of queries, so no task
holds more than a block of each. Each query also meets one bounded sample of
the vectors; its 21st best there is a floor below which no candidate is sent
on. Nothing above the floor is dropped.

Parameters: TABLES, BUCKET_ROWS, GOAL, MAX_PROBES, QUERY_SAMPLE (queries whose
true neighbours are found), FLOOR_SAMPLE (vectors that set the floor), BLOCK.

Defined results: null, zero and non-finite vectors (or with a null component)
take no part; vectors meet only those of their own length, other lengths than
the commonest without hashing, in blocks; a query's own row is left out once,
so rows repeated with its id are candidates; equal scores go by smaller id, a
null id last; a query with fewer candidates gets all that were found; an inner
product beyond a double's range is infinite (-inf if its terms are of both
signs); an empty table, or one vector, gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tenure.session import MAX_BROADCAST_ROWS, MAX_BROADCAST_ROWS_DEFAULT, conf_int, materialize

NEAREST = 20
TABLES = 2
BUCKET_ROWS = 1024
LEAST_BUCKETS = 16
GOAL = 0.96
MAX_PROBES = 128
QUERY_SAMPLE = 160
FLOOR_SAMPLE = 4096
BLOCK = 4096
SEED = 20250311
#: Stands for a null id, after all others.
NO_ID = np.iinfo(np.int64).max
#: Norms of a band this close count as equal.
FLAT = 1e-3


def hadamard(x: np.ndarray) -> np.ndarray:
    """The orthonormal Walsh-Hadamard transform of each row (a power of two long)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), 2)
        h *= 2
    return x.reshape(n, d) / np.sqrt(d)


class Polytopes:
    """One table: a bucket is a signed axis in each of several pseudo-rotations."""

    def __init__(self, dims: int, axes: list[int], seed: int):
        self.padded = 1 << max(0, (max(dims, *axes) - 1).bit_length())
        self.axes = axes  # unsigned axes used of each rotation
        rng = np.random.default_rng(seed)
        self.signs = rng.choice([-1.0, 1.0], (len(axes), 3, self.padded))

    def signed_axes(self, x: np.ndarray, k: int) -> np.ndarray:
        padded = np.zeros((len(x), self.padded))
        padded[:, : x.shape[1]] = x
        for s in self.signs[k]:
            padded = hadamard(padded * s)
        used = padded[:, : self.axes[k]]
        return np.concatenate((used, -used), 1)

    def code(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for k, a in enumerate(self.axes):
            out = out * (2 * a) + self.signed_axes(x, k).argmax(1)
        return out

    def probes(self, x: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` buckets (or all) nearest to each row, nearest first."""
        codes, cost = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
        for k, a in enumerate(self.axes):
            v = self.signed_axes(x, k)
            v = (v.max(1, keepdims=True) - v) ** 2
            near = np.argsort(v, 1, kind="stable")[:, :count]
            cost = (cost[:, :, None] + np.take_along_axis(v, near, 1)[:, None]).reshape(len(x), -1)
            codes = (codes[:, :, None] * (2 * a) + near[:, None]).reshape(len(x), -1)
            best = np.argsort(cost, 1, kind="stable")[:, :count]
            cost, codes = np.take_along_axis(cost, best, 1), np.take_along_axis(codes, best, 1)
        return codes


def axes_for(dims: int, buckets: int) -> list[int]:
    """Axes of each rotation, powers of two, for about so many buckets (at most 2^62)."""
    full = 1 << max(0, (dims - 1).bit_length())
    out, have = [], 1
    while have < buckets and have * 2 * full <= 1 << 62:
        a = 1
        while a < full and have * 2 * a < buckets:
            a *= 2
        out.append(a)
        have *= 2 * a
    return out or [1]


class Hash:
    """All tables for vectors of one length, with the norms' bands."""

    def __init__(self, dims: int, bands: dict[int, tuple[float, float]], axes: list[int], probes: int, tables: int):
        self.dims, self.bands, self.count = dims, bands, probes
        self.flat = all(low >= (1 - FLAT) * high for low, high in bands.values())
        self.tables = [Polytopes(dims + (not self.flat), axes, SEED + t) for t in range(tables)]

    def unit(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors as unit vectors whose angle to a query follows the inner product; their bands."""
        log, unit = log_norm(x)
        band = band_of(log)
        if self.flat:
            return unit, band
        top = np.array([self.bands[b][1] for b in band.tolist()])
        share = np.minimum(np.exp2(log - np.log2(top)), 1.0)
        return np.concatenate((unit * share[:, None], np.sqrt(1 - share**2)[:, None]), 1), band

    def query(self, x: np.ndarray) -> np.ndarray:
        unit = log_norm(x)[1]
        return unit if self.flat else np.concatenate((unit, np.zeros((len(x), 1))), 1)


def log_norm(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base-2 logarithm of the norms, and unit vectors; safe for huge and tiny entries."""
    big = np.abs(x).max(1, keepdims=True)
    x = x / big
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (np.log2(big) + np.log2(norm))[:, 0], x / norm


def band_of(log: np.ndarray) -> np.ndarray:
    """Bands of norms are factors of two, with 1 in the middle of band 0."""
    return np.floor(log + 0.5).astype(np.int64)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, each in the same order of additions; beyond a double's range infinite, or -inf if of no sign."""
    with np.errstate(over="ignore", invalid="ignore"):
        s = (a * b).sum(1)
    return np.where(np.isnan(s), -np.inf, s)


def _best(query: np.ndarray, vec_id: np.ndarray, score: np.ndarray, most: int) -> np.ndarray:
    """Rows of the ``most`` best of each query: by score, then id."""
    order = np.lexsort((vec_id, -score, query))
    q = query[order]
    starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return order[rank < most]


def _above(q: np.ndarray, least: np.ndarray, x: np.ndarray, ids: list, most: int) -> tuple[np.ndarray, ...]:
    """(query row, class row, place in its ids, id, score) of the ``most`` best rows of the classes x for each query, none below ``least``."""
    low = np.array([k[0] for k in ids], np.int64)
    rounding = np.exp2(np.minimum(log_norm(x)[0].max() + log_norm(q)[0], 1000.0)) * 1e-12  # of the products by blocks
    out = []
    for a in range(0, len(q), 256):
        with np.errstate(over="ignore", invalid="ignore"):
            s = q[a : a + 256] @ x.T
        s[np.isnan(s)] = -np.inf
        floor = least[a : a + 256]
        if s.shape[1] > most:  # only the best classes; which of equal ones is for their ids to say
            floor = np.maximum(floor, np.partition(s, s.shape[1] - most, axis=1)[:, s.shape[1] - most])
        i, j = np.nonzero(s >= (floor - rounding[a : a + 256])[:, None])
        if not len(i):
            continue
        i = i + a
        score = inner(q[i], x[j])
        keep = np.flatnonzero(score >= least[i])
        keep = keep[_best(i[keep], low[j[keep]], score[keep], most)]
        i, j, score = i[keep], j[keep], score[keep]
        n = np.array([len(ids[k]) for k in j.tolist()], np.int64)
        vec = np.concatenate([ids[k] for k in j.tolist()]) if len(j) else np.zeros(0, np.int64)
        place = np.arange(len(vec)) - np.repeat(np.cumsum(n) - n, n)
        i, j, score = np.repeat(i, n), np.repeat(j, n), np.repeat(score, n)
        keep = _best(i, vec, score, most)
        out.append((i[keep], j[keep], place[keep], vec[keep], score[keep]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.float64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _vectors(column, form: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), form).reshape(len(column), -1).astype(np.float64)


def _classes(rows: DataFrame, most: int) -> DataFrame:
    """(cid, d, v, ids, asks): each different vector once, with its smallest ids."""
    w = Window.partitionBy("d", "v").orderBy("vec_id")
    few = rows.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most)  # limited in every task before the shuffle
    ids = few.groupBy("d", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asks = rows.where("asks").select("d", "v", "asks").distinct()
    out = ids.join(asks, ["d", "v"], "left")
    return out.select(F.monotonically_increasing_id().alias("cid"), "d", "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks"))


def _packed(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column) -> tuple[DataFrame, str]:
    """(vec_id, asks, d, v): vectors that take part, as bytes of their own precision."""
    kind = vectors.schema[vector_col].dataType.elementType.simpleString()
    form, arrow = ("<f4", pa.float32()) if kind == "float" else ("<f8", pa.float64())
    v = F.col(f"`{vector_col}`")
    v = v if kind == "float" else v.cast("array<double>")
    rows = vectors.select(F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit(int(NO_ID))).alias("vec_id"), F.coalesce(is_query, F.lit(False)).alias("asks"), v.alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("v").isNotNull() & F.exists("v", lambda c: c != 0) & finite)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            n = np.asarray(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False), np.int64)
            flat = lists.flatten().cast(arrow).to_numpy(zero_copy_only=False) + 0  # -0 and 0 are one value
            raw, at = flat.astype(form).tobytes(), np.concatenate(([0], np.cumsum(n))) * int(form[2])
            v = [raw[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n.astype(np.int32)), pa.array(v, pa.binary())], names=["vec_id", "asks", "d", "v"])

    return rows.mapInArrow(pack, "vec_id bigint, asks boolean, d int, v binary"), form


def _norm_bands(classes: DataFrame, dims: int, form: str) -> dict[int, tuple[float, float]]:
    """The least and greatest norm of every band (there are at most about 2,200)."""

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[float, float]] = {}
        for batch in batches:
            if batch.num_rows:
                log = log_norm(_vectors(batch.column(0).to_pylist(), form))[0]
                band, value = band_of(log), np.exp2(np.minimum(log, 1023.0))
                for b in np.unique(band).tolist():
                    low, high = seen.get(b, (np.inf, 0.0))
                    seen[b] = min(low, float(value[band == b].min())), max(high, float(value[band == b].max()))
        low, high = zip(*seen.values(), strict=True) if seen else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(low, pa.float64()), pa.array(high, pa.float64())], names=["band", "low", "high"])

    found = classes.where(F.col("d") == dims).select("v").mapInArrow(norms, "band bigint, low double, high double")
    return {r["band"]: (r["low"], r["high"]) for r in found.groupBy("band").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()}


def _drawn(classes: DataFrame, total: int, most: int, salt: int) -> list:
    """About ``most`` of ``total`` classes by a hash of the vector: the same ones whenever asked."""
    rate = min(1.0, most / max(total, 1))
    return classes.where(F.pmod(F.xxhash64("v", F.lit(SEED + salt)), F.lit(1_000_003)) < rate * 1_000_003).select("cid", "v", "ids").orderBy("v").collect()


def _true_neighbours(classes: DataFrame, dims: int, form: str, asked: np.ndarray, most: int) -> list[tuple[int, bytes]]:
    """(query, neighbour's vector) of the ``most`` nearest classes of few queries, by one pass over all."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            raw = batch.column(0).to_pylist()
            for a in range(0, len(raw), 4096):
                part = raw[a : a + 4096]
                with np.errstate(over="ignore", invalid="ignore"):
                    s = np.nan_to_num(asked @ _vectors(part, form).T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                top = np.argsort(-s, 1, kind="stable")[:, :most]
                held = [sorted([*(held[q] if held else []), *((float(s[q, k]), part[k]) for k in top[q].tolist())], reverse=True)[:most] for q in range(len(asked))]
        rows = [(q, score, v) for q, best in enumerate(held) for score, v in best]
        q, score, v = zip(*rows, strict=True) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(score, pa.float64()), pa.array(v, pa.binary())], names=["q", "score", "v"])

    found = classes.where(F.col("d") == dims).select("v").mapInArrow(scan, "q int, score double, v binary")
    best = found.withColumn("k", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "v"))).where(F.col("k") <= most)
    return [(r["q"], r["v"]) for r in best.select("q", "v").collect()]


def fit(classes: DataFrame, dims: int, total: int, asked: int, form: str, nearest: int, tables: int, bucket_rows: int) -> Hash:
    """Tables for vectors of one length, with as many probes as the sampled queries need."""
    bands = _norm_bands(classes, dims, form)
    sample = _drawn(classes.where("asks").where(F.col("d") == dims), asked, QUERY_SAMPLE, 1)
    buckets = max(LEAST_BUCKETS, 1 << max(0, -(-total // bucket_rows) - 1).bit_length())
    if not sample:
        return Hash(dims, bands, axes_for(dims, buckets), MAX_PROBES, tables)
    query = _vectors([r["v"] for r in sample], form)
    truth = _true_neighbours(classes, dims, form, query, nearest + 1)
    own = [r["v"] for r in sample]
    truth = [(q, v) for q, v in truth if v != own[q]]
    while True:
        made = Hash(dims, bands, axes_for(dims, buckets), MAX_PROBES, tables)
        if not truth:
            return made
        q, near = np.array([q for q, _ in truth]), made.unit(_vectors([v for _, v in truth], form))[0]
        rank = np.full(len(q), MAX_PROBES)
        for table in made.tables:
            probes = table.probes(made.query(query), MAX_PROBES)
            hit = probes[q] == table.code(near)[:, None]
            rank = np.minimum(rank, np.where(hit.any(1), hit.argmax(1), MAX_PROBES))
        needed = int(np.sort(rank)[max(0, int(np.ceil(GOAL * len(rank))) - 1)])
        if needed < MAX_PROBES or buckets <= 2:
            made.count = min(needed + 1, MAX_PROBES)
            return made
        buckets //= 2


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    nearest: int = NEAREST,
    tables: int = TABLES,
    bucket_rows: int = BUCKET_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """query_id, rank, vec_id, score of the nearest vectors found for the rows where ``is_query`` holds."""
    spark = vectors.sparkSession
    most = nearest + 1  # a query's own row is among its best and goes at the end
    rows, form = _packed(vectors, id_col, vector_col, is_query)
    classes = materialize(_classes(rows, most), "classes")
    common = classes.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked")).orderBy(F.desc("n"), "d").limit(1).collect()
    dims, total, asked = common[0] if common else (0, 0, 0)
    made = fit(classes, dims, total, asked, form, nearest, tables, bucket_rows) if total else None
    bands = sorted(made.bands) if made else []
    drawn = _drawn(classes.where(F.col("d") == dims), total, FLOOR_SAMPLE, 2) if asked else []
    few = _vectors([r["v"] for r in drawn], form) if drawn else None
    few_ids, few_cid = [np.array(r["ids"], np.int64) for r in drawn], np.array([r["cid"] for r in drawn], np.int64)

    def places(x: np.ndarray, length: np.ndarray, asking: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, query, t, band, code): a bucket in every table for each row, and the probed ones for rows that ask; x holds the rows of the common length."""
        usual, other, parts = np.flatnonzero(length == dims), np.flatnonzero(length != dims), []
        if len(usual):
            unit, band = made.unit(x)
            ask = np.flatnonzero(asking[usual])
            for t, hashed in enumerate(made.tables):
                parts.append((usual, np.zeros(len(usual), bool), np.full(len(usual), t), band, hashed.code(unit)))
                if len(ask):
                    probes = hashed.probes(made.query(x[ask]), made.count)
                    each = np.repeat(usual[ask], probes.shape[1])
                    for b in bands:
                        parts.append((each, np.ones(len(each), bool), np.full(len(each), t), np.full(len(each), b), probes.ravel()))
        for query, mine in ((False, other), (True, other[asking[other]])):  # other lengths: one bucket each, dealt out in blocks
            parts.append((mine, np.full(len(mine), query), np.full(len(mine), -2), length[mine].astype(np.int64), np.zeros(len(mine), np.int64)))
        return tuple(np.concatenate(c) for c in zip(*parts, strict=True))

    def read(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        for a in range(0, batch.num_rows, 2048):
            part = batch.slice(a, 2048)
            length, asking = part.column(1).to_numpy(zero_copy_only=False), np.array(part.column(2).to_pylist(), bool)
            usual = np.flatnonzero(length == dims)
            raw = part.column(3).take(pa.array(usual)).to_pylist()
            yield part, length, asking, _vectors(raw, form) if raw else np.zeros((0, dims))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, length, asking, x in read(batch):
                _, query, *key = places(x, length, asking)
                unique, at = np.unique(np.stack(key, 1), axis=0, return_inverse=True)
                n = [np.bincount(at.ravel(), weights=w, minlength=len(unique)).astype(np.int64) for w in (~query, query)]
                yield pa.RecordBatch.from_arrays([pa.array(unique[:, 0].astype(np.int32)), *map(pa.array, (unique[:, 1], unique[:, 2], *n))], names=["t", "band", "code", "n", "asked"])

    def sampled(x: np.ndarray) -> tuple[np.ndarray, ...]:
        """The best rows of the sample for queries x."""
        return _above(x, np.full(len(x), -np.inf), few, few_ids, most)

    answer = "cid bigint, cand bigint, place int, vec_id bigint, score double"

    def from_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, length, _, x in read(batch):
                if few is not None and len(x):
                    i, j, place, vec, score = sampled(x)
                    columns = [part.column(0).take(pa.array(np.flatnonzero(length == dims)[i])), pa.array(few_cid[j]), pa.array(place.astype(np.int32)), pa.array(vec), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in answer.split(", ")])

    spec = "t int, band bigint, code bigint, query boolean, cid bigint, low double, v binary, ids array<bigint>"
    names = [c.split()[0] for c in spec.split(", ")]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, length, asking, x in read(batch):
                cid, _, _, v, ids = (part.column(k) for k in range(5))
                low = np.full(len(length), -np.inf)
                ask = np.flatnonzero(asking & (length == dims))
                if few is not None and len(ask):
                    i, *_, score = sampled(x[asking[length == dims]])
                    least = np.full(len(ask), np.inf)
                    np.minimum.at(least, i, score)
                    low[ask] = np.where(np.bincount(i, minlength=len(ask)) >= most, least, -np.inf)
                row, query, t, band, code = places(x, length, asking)
                take = pa.array(row)
                mine = pa.array([None if q else i for q, i in zip(query.tolist(), ids.take(take).to_pylist(), strict=True)], pa.list_(pa.int64()))
                columns = [pa.array(t.astype(np.int32)), pa.array(band), pa.array(code), pa.array(query), cid.take(take), pa.array(low[row]), v.take(take), mine]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    key = ["t", "band", "code"]
    counts = classes.select("cid", "d", "asks", "v").mapInArrow(count, "t int, band bigint, code bigint, n bigint, asked bigint")
    counts = counts.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("asked").alias("asked")).where((F.col("n") > block) | (F.col("asked") > block))
    crowd = materialize(counts.select(*key, F.ceil(F.col("n") / block).cast("int").alias("kv"), F.ceil(F.col("asked") / block).cast("int").alias("kq")), "crowded")
    side = F.broadcast(crowd) if crowd.count() <= conf_int(spark, MAX_BROADCAST_ROWS, MAX_BROADCAST_ROWS_DEFAULT) else crowd
    dealt = classes.select("cid", "d", "asks", "v", "ids").mapInArrow(deal, spec).join(side, key, "left")
    kv, kq = (F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) for c in ("kv", "kq"))
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("cid"), F.when(F.col("query"), kq).otherwise(kv)).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("query"), kv).otherwise(kq) - 1)))
    bv, bq = F.when(F.col("query"), F.col("other")).otherwise(F.col("mine")), F.when(F.col("query"), F.col("mine")).otherwise(F.col("other"))
    pair = dealt.select(*key, bv.alias("bv"), bq.alias("bq"), "query", "cid", "low", "v", "ids")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        asks = part["query"].to_numpy(bool)
        if asks.all() or not asks.any():
            return pd.DataFrame({c: [] for c in ("cid", "cand", "place", "vec_id", "score")})
        q, x = part[asks], part[~asks]
        i, j, place, vec, score = _above(_vectors(q["v"].tolist(), form), q["low"].to_numpy(), _vectors(x["v"].tolist(), form), [np.asarray(k, np.int64) for k in x["ids"]], most)
        return pd.DataFrame({"cid": q["cid"].to_numpy()[i], "cand": x["cid"].to_numpy()[j], "place": place, "vec_id": vec, "score": score})

    found = pair.groupBy(*key, "bv", "bq").applyInPandas(compare, answer)
    found = found.unionByName(classes.where("asks").select("cid", "d", "asks", "v").mapInArrow(from_sample, answer))
    found = found.groupBy("cid", "cand", "place").agg(F.first("vec_id").alias("vec_id"), F.first("score").alias("score"))  # tables find the same rows
    best = found.withColumn("k", F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("score"), "vec_id", "cand", "place"))).where(F.col("k") <= most)
    best = best.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("k", "vec_id", "score", "cand"))).alias("best"))
    asked_rows = rows.where("asks").select("d", "v", F.col("vec_id").alias("query_id")).join(classes.where("asks").select("d", "v", "cid"), ["d", "v"])
    each = asked_rows.join(best, "cid")
    own = F.array_position(F.transform("best", lambda r: (r["cand"] == F.col("cid")) & (r["vec_id"] == F.col("query_id"))), True)
    each = each.withColumn("own", own).withColumn("best", F.slice(F.filter("best", lambda r, i: i + 1 != F.col("own")), 1, nearest))
    each = each.select("query_id", F.posexplode("best").alias("i", "r"))
    return each.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.nullif("r.vec_id", F.lit(int(NO_ID))).alias("vec_id"), "r.score")
