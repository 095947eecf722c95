"""MinHash near-duplicates by an LSH forest, confirmed on full shingle sets.

Equal shingle sets are folded into classes first, so a group of copies is one
row however large it is. Each class has a signature of MinHash values. A tree
of the forest is one order of these values; classes that agree on its first
DEPTH values share a region. Inside a region classes are sorted by their
further values, so neighbours have the longest common prefix: dense regions
are thereby compared at greater depth. The first round takes these neighbours.

Neighbours alone could miss a pair, so an exact round follows: regions that
still hold several components are compared whole, in blocks dealt out to
tasks, and pairs from different components are confirmed. Pairs inside one
component need no confirming. Candidates pass a signature estimate far below the limit; a link counts only
after the intersection of the two full sets.

With TREES orders of DEPTH values a pair at similarity 0.75 shares no region
with a chance of about 1e-4.

Defined results: null and empty texts have no shingles, link with nothing and
are their own component; ids may be of any type; rows that repeat a doc_id each
get a row; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.session import materialize

from .common import as_binary, chunks, free_name, row_key, utf8
from .components import connected

WORDS = 5
PERCENT = 75
HASHES = 128
TREES = 24
DEPTH = 4
FURTHER = 6
BLOCK = 1024
#: Groups up to this size are compared side by side in numpy.
SMALL = 32
#: Least estimated similarity of a candidate; at 128 values 0.75 is estimated below it once in 3,000.
ESTIMATE = 0.62
CACHE_WORDS = 400_000

_RNG = np.random.default_rng(7919)
_MULTIPLY = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
#: Orders of the signature: the first DEPTH values of the trees overlap as little as they can.
_FIRST = np.concatenate([_RNG.permutation(HASHES) for _ in range(-(-TREES * DEPTH // HASHES))])
_ORDERS = np.array([[*(head := _FIRST[t * DEPTH : (t + 1) * DEPTH]), *[x for x in _RNG.permutation(HASHES) if x not in head][:FURTHER]] for t in range(TREES)])
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Codes(dict):
    """A 64-bit code of each word, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        code = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return code


def shingles(text: bytes, codes: Codes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit codes of the text's word shingles (A-Z lower-cased)."""
    found = text.lower().split()  # on bytes, only A-Z change
    if not found:
        return np.zeros(0, np.uint64)
    c = np.fromiter(map(codes.__getitem__, found), np.uint64, len(found))
    n = min(words, len(c))
    h = np.full(len(c) - n + 1, n, np.uint64)
    for k in range(n):
        h = h * _BASE + c[k : len(c) - n + 1 + k]
    return np.unique(mix(h))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values (sets x HASHES); all sets non-empty."""
    flat = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), HASHES), np.uint32)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((flat * _MULTIPLY[k] + _ADD[k]) >> np.uint64(32), starts)
    return out


WIDE = "region bigint, tree int, cid bigint, n bigint, further binary, sketch binary, tags binary"
SIGNED = "n_shingles bigint, digest binary, sig binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = Codes()
    for batch in chunks(batches):
        sets = [shingles(t, codes) for t in utf8(batch)]
        full = [k for k, s in enumerate(sets) if len(s)]
        digest, sig = [None] * len(sets), [None] * len(sets)
        if full:
            for k, row in zip(full, signatures([sets[k] for k in full]), strict=True):
                digest[k], sig[k] = hashlib.blake2b(sets[k].tobytes(), digest_size=16).digest(), row.tobytes()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
            names=["doc_id", "n_shingles", "digest", "sig"],
        )


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes = Codes()
    for batch in chunks(batches):
        sets = [shingles(t, codes) for t in utf8(batch)]
        digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [pa.array(digest, pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["digest", "shingles"]
        )


def _values(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _region(sig: np.ndarray, tree: int) -> np.ndarray:
    key = np.full(len(sig), tree + 1, np.uint64)
    for k in _ORDERS[tree][:DEPTH]:
        key = mix(key * _BASE + sig[:, k])
    return key


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, cid = _values(batch.column(1)), batch.column(0).to_numpy()
        for t in range(TREES):
            yield pa.RecordBatch.from_arrays([pa.array(_region(sig, t).view(np.int64)), pa.array(np.full(len(sig), t, np.int32)), pa.array(cid)], names=["region", "tree", "cid"])


def _deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``further`` sorts a region, ``sketch`` is a byte of each value, ``tags`` tell the regions of all trees."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, tree = _values(batch.column(4)), batch.column(1).to_numpy()
        further = np.take_along_axis(sig, _ORDERS[tree][:, DEPTH:], axis=1).astype(">u4")
        low = (sig & 0xFF).astype(np.uint8)
        tags = np.column_stack([_region(sig, t) >> np.uint64(32) for t in range(TREES)]).astype(np.uint32)
        packed = [pa.array([x.tobytes() for x in part], pa.binary()) for part in (further, low, tags)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *packed], names=["region", "tree", "cid", "n", "further", "sketch", "tags"])


def _estimate(equal: np.ndarray) -> np.ndarray:
    return (equal / HASHES - 1 / 256) / (1 - 1 / 256)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a class with the next two in its sorted region whose estimate passes."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        region, cid, n = (batch.column(c).to_numpy() for c in ("region", "cid", "n"))
        sketch = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
        if last is not None:
            region, cid, n, sketch = (np.concatenate((a, b)) for a, b in zip(last, (region, cid, n, sketch), strict=True))
        last = region[-2:], cid[-2:], n[-2:], sketch[-2:]
        a, b, est = [], [], []
        for step in (1, 2):
            i = np.flatnonzero(region[step:] == region[:-step])
            j = i + step
            e = _estimate((sketch[i] == sketch[j]).sum(1))
            ok = (e >= ESTIMATE) & (100 * np.minimum(n[i], n[j]) >= PERCENT * np.maximum(n[i], n[j]))
            a.append(np.minimum(cid[i], cid[j])[ok])
            b.append(np.maximum(cid[i], cid[j])[ok])
            est.append(e[ok])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (a, b, est)], names=["a", "b", "est"])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from sorted batches; a group is equal values in the first ``keys`` columns."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        rest = t if rest is None else pa.concat_tables([rest, t])
        k = [c.to_numpy() for c in rest.columns[:keys]]
        new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in k], axis=0)) + 1
        if len(new):
            yield rest.slice(0, int(new[-1]))
            rest = rest.slice(int(new[-1]))
    if rest is not None and rest.num_rows:
        yield rest


def _across(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers (x, y) of candidate pairs from different components, and their estimates.

    ``t`` holds whole regions, or pairs of blocks of one (region, b0, b1, half).
    A pair that shares a region of an earlier tree is left to that region.
    """
    region, b0, b1, half, tree, n, comp = (t.column(c).to_numpy() for c in ("region", "b0", "b1", "half", "tree", "n", "comp"))
    sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, HASHES)
    tags = np.frombuffer(b"".join(t.column("tags").to_pylist()), np.uint32).reshape(-1, TREES)
    new = np.flatnonzero(np.append(True, (region[1:] != region[:-1]) | (b0[1:] != b0[:-1]) | (b1[1:] != b1[:-1])))
    sizes = np.diff(np.append(new, len(region)))
    group = np.repeat(np.arange(len(new)), sizes)
    two = (b0 != b1)  # between two blocks only pairs across them
    found = []

    def test(x, y):
        ok = (comp[x] != comp[y]) & (~two[x] | (half[x] != half[y])) & (100 * np.minimum(n[x], n[y]) >= PERCENT * np.maximum(n[x], n[y]))
        x, y = x[ok], y[ok]
        est = _estimate((sketch[x] == sketch[y]).sum(1))
        ok = est >= ESTIMATE
        x, y, est = x[ok], y[ok], est[ok]
        ok = ~((tags[x] == tags[y]) & (np.arange(TREES) < tree[x][:, None])).any(1)
        found.append((x[ok], y[ok], est[ok]))

    small = np.flatnonzero((sizes <= SMALL)[group])
    for step in range(1, int(min(SMALL, sizes.max()))):
        x = small[small + step < len(group)]
        x = x[group[x] == group[x + step]]
        for s in range(0, len(x), 65536):
            test(x[s : s + 65536], x[s : s + 65536] + step)
    for k in np.flatnonzero(sizes > SMALL):
        rows = np.arange(new[k], new[k] + sizes[k])
        values, counts = np.unique(comp[rows], return_counts=True)
        # pairs within the largest component are settled: only its outsiders look for partners
        outside = comp[rows] != values[counts.argmax()]
        for x in rows[outside]:
            test(*np.broadcast_arrays(x, rows[~outside | (rows > x)]))
    if not found:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate(f) for f in zip(*found, strict=True))


def _open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that have a candidate in another component."""
    for t in _groups(batches, 3):
        x, y, _ = _across(t)
        yield from t.take(np.unique(np.concatenate((x, y)))).to_batches()


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between components, confirmed on full sets, as far as they join what is apart."""
    for t in _groups(batches, 3):
        x, y, est = _across(t)
        order = np.argsort(-est, kind="stable")
        sets, cid = t.column("shingles").combine_chunks(), t.column("cid").to_numpy()
        values, label = np.unique(t.column("comp").to_numpy(), return_inverse=True)
        up = list(range(len(values)))
        a, b = [], []
        for i, j in zip(x[order].tolist(), y[order].tolist(), strict=True):
            p, q = int(label[i]), int(label[j])
            while up[p] != p:
                p = up[p]
            while up[q] != q:
                q = up[q]
            if p == q:
                continue
            s, u = sets[i].values.to_numpy(), sets[j].values.to_numpy()
            both = len(np.intersect1d(s, u, assume_unique=True))
            if 100 * both >= PERCENT * (len(s) + len(u) - both):
                up[max(p, q)] = min(p, q)
                a.append(int(cid[i]))
                b.append(int(cid[j]))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the limit."""
    left = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _remainder(members: DataFrame, wide: DataFrame, sizes: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the components that ``links`` leave apart inside one region.

    Regions of more than BLOCK classes are dealt out as pairs of blocks. A
    first pass finds the classes with a candidate in another component; only
    these get their sets, and the same pairs are then confirmed in place, so
    the rows moved are classes, never pairs.
    """
    roots = materialize(connected(links).withColumnRenamed("node", "cid"), "roots")
    at = members.select("region", "cid").join(roots, "cid", "left").select("region", "cid", F.coalesce("root", "cid").alias("comp"))
    apart = at.groupBy("region").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("region").join(sizes, "region")
    rows = wide.drop("further").join(apart, "region").join(roots, "cid", "left").withColumn("comp", F.coalesce("root", "cid"))
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("k")).cast("int")).select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    rows = rows.select(
        "region", F.least("mine", "other").alias("b0"), F.greatest("mine", "other").alias("b1"), F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("half"),
        "tree", "cid", "n", "comp", "sketch", "tags",
    )
    keys = ["region", "b0", "b1"]
    rows = materialize(rows.repartition(*keys).sortWithinPartitions(*keys, "cid").mapInArrow(_open_rows, rows.schema), "open")
    whole = rows.join(sets, "cid").select(*rows.columns, "shingles")
    return materialize(whole.repartition(*keys).sortWithinPartitions(*keys, "cid").mapInArrow(_exact, "a bigint, b bigint"), "links")


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = as_binary(docs, id_col, text=text_col).withColumnRenamed(id_col, "doc_id")
    signed = materialize(rows.mapInArrow(_sign, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SIGNED}"), "signatures")
    classes = signed.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("low_id"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), "*"), "classes")

    regions = classes.select("cid", "sig").mapInArrow(_regions, "region bigint, tree int, cid bigint")
    crowded = regions.groupBy("region").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = materialize(regions.join(crowded, "region").select("region", "tree", "cid", "size"), "members")
    sizes = members.select("region", F.ceil(F.col("size") / BLOCK).cast("int").alias("k")).distinct()
    active = materialize(members.select("cid").distinct().join(classes.drop("sig"), "cid"), "active")
    wide = members.select("region", "tree", "cid").join(classes.select("cid", "n", "sig"), "cid").select("region", "tree", "cid", "n", "sig")
    wide = materialize(wide.mapInArrow(_deepen, WIDE), "regions")

    wanted = active.select(F.col("low_id").alias("want")).distinct().hint("merge")
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("want")), "left_semi").select("text")
    sets = texts.mapInArrow(_whole, "digest binary, shingles array<bigint>").dropDuplicates(["digest"])
    sets = materialize(sets.join(active, "digest").select("cid", "shingles"), "sets")

    sorted_ = wide.repartitionByRange(F.col("region"), F.col("further"), F.col("cid")).sortWithinPartitions("region", "further", "cid")
    near = sorted_.mapInArrow(_neighbours, "a bigint, b bigint, est double").groupBy("a", "b").agg(F.max("est").alias("est"))
    ends = near.select("*", F.explode(F.array("a", "b")).alias("end"))
    # a class is next to at most four others in each tree, so these windows are small
    best = Window.partitionBy("end").orderBy(F.desc("est"), "a", "b")
    tried = materialize(ends.withColumn("rank", F.row_number().over(best)).where("rank <= 3").select("a", "b").distinct(), "tried")
    links = materialize(_confirm(tried, sets), "links")
    links = links.unionByName(_remainder(members, wide, sizes, links, sets))
    roots = connected(links)
    named = classes.select("cid", "digest", "low_id").join(roots.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))
    named = named.join(named.groupBy("root").agg(F.min("low_id").alias("component_id")), "root").select("digest", "component_id")
    out = signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    found = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", found.alias("component_id"), F.col("doc_id").eqNullSafe(found).alias("kept"))


def _row_name(id_: Column, kind: T.DataType, text: Column) -> Column:
    """A name for a row that sorts as its id does (whole numbers by value, null last) and tells its text."""
    place = id_.cast("string")
    if isinstance(kind, T.IntegralType):
        place = F.lpad((id_.cast("decimal(21,0)") + F.lit(str(1 << 63)).cast("decimal(21,0)")).cast("string"), 20, "0")
    return F.concat(F.coalesce(F.concat(F.lit("0"), place), F.lit("1")), F.lit(":"), row_key(id_, text))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Exactly one row of each near-duplicate group stays, that with the smallest id; columns unchanged.

    Rows are told apart by id and text, so a text of its own stays though
    another row with its id goes; of rows that repeat in both one stays. Rows
    without words are in no group and all stay.
    """
    name = free_name(docs, "row_name")
    named = docs.withColumn(name, _row_name(F.col(f"`{id_col}`"), docs.schema[id_col].dataType, F.col(f"`{text_col}`")))
    found = materialize(near_documents(named, name, text_col).select("doc_id", "n_shingles", "kept"), "found")
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    left = named.join(gone.hint("merge"), name, "left_anti")
    again = found.where(F.col("kept") & (F.col("n_shingles") > 0)).groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    again = materialize(again.select(F.col("doc_id").alias(name)), "repeated")
    if not again.isEmpty():  # rows equal in id and text: one of each
        once = left.join(again.hint("merge"), name, "left_semi").dropDuplicates([name])
        left = left.join(again.hint("merge"), name, "left_anti").unionByName(once)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = """
with recursive split as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w
  from documents),
shingles as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from split where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
linked as (select a, b from common c join sizes x on x.doc_id = c.a join sizes y on y.doc_id = c.b where 100 * c.c >= 75 * (x.n + y.n - c.c)),
ways as (select a, b from linked union all select b, a from linked),
reach as (select doc_id, doc_id as root from split union select w.b, r.root from reach r join ways w on w.a = r.doc_id),
lowest as (select doc_id, min(root) as component_id from reach group by doc_id)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id, d.doc_id = component_id as kept
from split d join lowest using (doc_id) left join sizes using (doc_id)
"""
