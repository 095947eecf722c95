"""Near-duplicate vectors by a forest of random-projection trees.

Equal vectors are first folded into classes by an aggregate. A forest is
fitted on a bounded sample of classes: each node projects its points on a
random direction and splits at the median; points within a margin of the
split go down both sides (spill overlap), so close pairs part rarely. Every
class vector is then routed down every tree and compared, in double precision,
with the vectors of its leaves. Trees are grown until a leaf stands for about
LEAF_ROWS vectors of the table, by the table's exact count, down to LEAST_LEAF
points of the sample; so leaves keep their size, and the work its proportion to
the table, up to about SAMPLE * LEAF_ROWS / LEAST_LEAF vectors (beyond that
``sample`` is the parameter to raise). Nodes share a pool of directions, so the
trees stay small. Leaves larger than a block are dealt out as
pairs of blocks, so no task holds more than two blocks and no pair is lost.

A leaf task returns one row per vector, not per pair: the number of vectors it
links with, counted only where this leaf is the first that the pair shares, and
the smallest class its local union reaches. Sums and connected components over
these rows give the answer.

The margin is ``spill`` standard deviations of the projected distance of a
pair at the similarity limit. Each split adds, for every sampled point, the
chance that it parts from a neighbour at the limit in a random direction; where
their sum in a tree, averaged over points by their number of neighbours, would
pass what MISSED allows, the node stays a leaf. So dense groups stop early and
are compared in blocks. A pair at the limit then parts in all trees with a
chance of about MISSED, if the sample stands for the table; a third of 20,000
vectors in one group around 0.94 to 0.95 lost under one link in a thousand in trials.

Defined results: null, zero and non-finite vectors (or vectors with a null
component) link with nothing and are their own component; vectors of different
lengths never link; repeated rows and repeated ids are rows of their own, and
equal vectors link with each other; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import erfc

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.session import materialize

from .components import connected, merge

SIMILARITY = 0.95
TREES = 8
SAMPLE = 20_000
LEAF = 48  # most sampled points in a leaf
LEAF_ROWS = 192  # vectors of the table that a leaf stands for
LEAST_LEAF = 4  # sampled points below which a node's median says too little
POOL = 2048  # directions that nodes choose from
BLOCK = 2048  # vectors in a block of a large leaf
SPILL = 0.4
MISSED = 5e-4  # chance at which a pair at the limit may part in all trees
SEED = 20240607


_AT = np.linspace(0, 8, 1601)
_TAIL = np.array([0.5 * erfc(z / 2**0.5) for z in _AT])


def _beyond(z: np.ndarray) -> np.ndarray:
    """Chance that a standard normal value is above ``z`` >= 0."""
    return np.interp(z, _AT, _TAIL, right=0.0)


class Forest:
    """Trees fitted on a sample: arrays of directions, thresholds and children."""

    def __init__(self, points: np.ndarray, trees: int, leaf: int, margin: float, seed: int, sigma: float, similarity: float = SIMILARITY):
        rng = np.random.default_rng(seed)
        some = points[:: max(1, len(points) // 2000)]
        near = [(points[k : k + 2048] @ some.T >= similarity).sum(1) for k in range(0, len(points), 2048)]
        self.weight = 1 + np.concatenate([*near, []]) * (len(points) / max(len(some), 1))  # points count by their neighbours
        self.sigma = sigma  # of the projected distance of a pair at the limit
        self.bound = -float(np.log1p(-(MISSED ** (1 / trees))))  # of a tree's summed chances
        self.margin, self.roots = margin, []
        self.at: list[tuple] = []  # (direction number, threshold, left, right) or a leaf's number
        pool = rng.standard_normal((POOL, points.shape[1]))
        self.directions = pool / np.linalg.norm(pool, axis=1, keepdims=True)
        self.leaves = 0
        for _ in range(trees):
            self.roots.append(self._grow(points, np.arange(len(points)), np.zeros(len(points)), leaf, rng))

    def _grow(self, points, mine, risk, leaf, rng) -> int:
        here = len(self.at)
        self.at.append(())
        if len(mine) > leaf:
            best = None
            for d in rng.integers(0, len(self.directions), 3).tolist():
                x = points[mine] @ self.directions[d]
                cut = float(np.median(x))
                left, right = x <= cut + self.margin, x > cut - self.margin
                if best is None or left.sum() + right.sum() < best[2].sum() + best[3].sum():
                    best = d, cut, left, right, x
            d, cut, left, right, x = best
            # a neighbour parts if it lies beyond the other margin; points in the overlap part from none.
            # Points of a dense group have their neighbours wherever the group's points are.
            w = self.weight[mine]
            over = np.where(left, w[~left].sum(), w[~right].sum()) / w.sum() * np.maximum(1 - leaf / w, 0)
            risk = risk + np.where(left & right, 0, np.maximum(over, _beyond((np.abs(x - cut) + self.margin) / self.sigma)))
            # points closer together than the margin cannot be parted: they stay one leaf, compared in blocks
            if left.sum() + right.sum() <= 1.5 * len(mine) and max(self._mean(mine, risk, left), self._mean(mine, risk, right)) <= self.bound:
                self.at[here] = (d, cut, self._grow(points, mine[left], risk[left], leaf, rng), self._grow(points, mine[right], risk[right], leaf, rng))
                return here
        self.at[here] = self.leaves
        self.leaves += 1
        return here

    def _mean(self, mine, risk, side) -> float:
        return float(np.average(risk[side], weights=self.weight[mine[side]])) if side.any() else 0.0

    def route(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf that each row reaches."""
        rows, leaves = [], []
        for root in self.roots:
            todo = [(root, np.arange(len(points)))]
            while todo:
                node, mine = todo.pop()
                if not len(mine):
                    continue
                at = self.at[node]
                if isinstance(at, tuple):
                    x = points[mine] @ self.directions[at[0]]
                    todo += [(at[2], mine[x <= at[1] + self.margin]), (at[3], mine[x > at[1] - self.margin])]
                else:
                    rows.append(mine)
                    leaves.append(np.full(len(mine), at))
        return np.concatenate(rows), np.concatenate(leaves)


def _unit(values: np.ndarray) -> np.ndarray:
    big = np.abs(values).max(1, keepdims=True)
    values = values / big
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest leaf number in both padded rows (-1 pads a, -2 pads b)."""
    best = np.full(len(a), np.iinfo(np.int32).max, np.int32)
    for k in range(a.shape[1]):
        hit = (a[:, k : k + 1] == b).any(1)
        best = np.where(hit, np.minimum(best, a[:, k]), best)
    return best


def _padded(lists: list[bytes], pad: int) -> np.ndarray:
    """Packed lists of leaves as the rows of one array."""
    n = np.array([len(x) // 4 for x in lists])
    out = np.full((len(lists), int(n.max())), pad, np.int32)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer(b"".join(lists), "<i4")
    return out


def compare(part: pd.DataFrame, leaf: int, similarity: float, form: str) -> pd.DataFrame:
    """Links inside one leaf (or between two blocks of it), one row per linked class.

    ``half`` 0 and 1 are the two blocks; a block compared with itself has half 0 only.
    """
    part = part.sort_values("cid", kind="stable").reset_index(drop=True)
    x = _unit(np.frombuffer(b"".join(part["v"].tolist()), form).reshape(len(part), -1).astype(np.float64))
    own, size = part["half"].to_numpy(), part["n"].to_numpy()
    left = np.flatnonzero(own == 0)
    one_block = len(left) == len(part)
    right = left if one_block else np.flatnonzero(own == 1)
    la, lb = _padded(part["leaves"].tolist(), -1), _padded(part["leaves"].tolist(), -2)
    links, label, touched = np.zeros(len(part), np.int64), np.arange(len(part)), np.zeros(len(part), bool)
    for a in range(0, len(left), 512):
        rows = left[a : a + 512]
        i, j = np.nonzero(x[rows] @ x[right].T >= similarity)
        i, j = rows[i], right[j]
        if one_block:
            i, j = i[i < j], j[i < j]
        touched[i] = touched[j] = True
        for s in range(0, len(i), 100_000):
            p, q = i[s : s + 100_000], j[s : s + 100_000]
            mine = _first_shared(la[p], lb[q]) == leaf
            np.add.at(links, p[mine], size[q[mine]])
            np.add.at(links, q[mine], size[p[mine]])
        merge(label, i, j)
    cid = part["cid"].to_numpy()
    return pd.DataFrame({"cid": cid[touched], "links": links[touched], "low": cid[label][touched]})


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    similarity: float = SIMILARITY,
    trees: int = TREES,
    sample: int = SAMPLE,
    leaf: int = LEAF,
    block: int = BLOCK,
    spill: float = SPILL,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    The links are the pairs with cosine of at least ``similarity`` that share
    a leaf; each was computed in double precision from the whole vectors.
    """
    single = vectors.schema[vector_col].dataType.elementType.simpleString() == "float"
    form = "<f4" if single else "<f8"  # vectors travel in their own precision
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    ok = F.col("v").isNotNull() & F.exists("v", lambda c: c != 0) & F.forall("v", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))
    rows = rows.withColumn("v", F.when(ok, F.transform("v", lambda c: c + 0.0)))
    classes = rows.where(F.col("v").isNotNull()).groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("low_id"))
    classes = materialize(classes.select(F.monotonically_increasing_id().alias("cid"), "v", "n", "low_id"), "classes")
    by_size = {r["d"]: r["n"] for r in classes.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(64).collect()}
    dims = max(by_size, default=0, key=lambda d: (by_size[d], d))
    total = by_size.get(dims, 0)
    rate = min(1.0, sample / max(total, 1))
    drawn = classes.where((F.size("v") == dims) & (F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1_000_003)) < rate * 1_000_003)).select("v").orderBy("v").toArrow()
    points = _unit(np.array(drawn.column("v").to_pylist(), np.float64)) if drawn.num_rows else np.zeros((0, max(dims, 1)))
    sigma = float(np.sqrt((2 - 2 * similarity) / max(dims, 1)))
    stands = min(leaf, max(LEAST_LEAF, int(LEAF_ROWS * len(points) / max(total, 1))))
    forest = Forest(points, trees, stands, spill * sigma, seed, sigma, similarity)
    last = forest.leaves
    spec = "cid bigint, n bigint, v binary, leaf int, leaves binary"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, 2000) for b in batches for k in range(0, b.num_rows, 2000)):
            lists = batch.column(2)
            lengths = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat, starts = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(lengths)))
            for size in np.unique(lengths).tolist():
                mine = np.flatnonzero(lengths == size)
                x = flat[starts[mine][:, None] + np.arange(size)]
                if size == dims:
                    row, leaf_no = forest.route(_unit(x))
                else:  # vectors of another length meet in one leaf of their own, dealt out in blocks
                    row, leaf_no = np.arange(len(mine)), np.full(len(mine), last + int(size))
                order = np.lexsort((leaf_no, row))
                row, leaf_no = row[order], leaf_no[order].astype("<i4")
                packed, width = x.astype(form).tobytes(), size * int(form[2])
                v = pa.array([packed[k * width : (k + 1) * width] for k in range(len(mine))], pa.binary())
                at = np.flatnonzero(np.diff(row, prepend=-1))
                raw, ends = leaf_no.tobytes(), np.append(at[1:], len(row))
                leaves = pa.array([raw[4 * i : 4 * j] for i, j in zip(at.tolist(), ends.tolist(), strict=True)], pa.binary())
                take = pa.array(row)
                classes_ = (batch.column(k).take(pa.array(mine)).take(take) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([*classes_, v.take(take), pa.array(leaf_no), leaves.take(take)], names=["cid", "n", "v", "leaf", "leaves"])

    routed = classes.select("cid", "n", "v").mapInArrow(route, spec)
    # at most `trees` x `sample` / `leaf` x overlap leaves, whatever the table's size
    crowd = routed.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    crowd = materialize(crowd.select("leaf", F.ceil(F.col("rows") / block).cast("int").alias("k")), "leaves")
    dealt = routed.join(F.broadcast(crowd), "leaf").withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("k")).cast("int"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other"))
    pair = dealt.select("leaf", F.least("mine", "other").alias("b0"), F.greatest("mine", "other").alias("b1"), F.when(F.col("mine") <= F.col("other"), 0).otherwise(1).alias("half"), "cid", "n", "v", "leaves")

    def leaf_links(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return compare(part, key[0], similarity, form)

    found = pair.groupBy("leaf", "b0", "b1").applyInPandas(leaf_links, "cid bigint, links bigint, low bigint")
    found = materialize(found, "links")
    counts = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("cid").alias("a"), F.col("low").alias("b")))
    named = classes.select("cid", "n", "low_id", "v").join(counts, "cid", "left").join(roots.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.withColumn("root", F.coalesce("root", "cid"))
    lowest = named.groupBy("root").agg(F.min("low_id").alias("component_id"))
    named = named.join(lowest, "root").select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    linked = rows.where(F.col("v").isNotNull()).join(named, "v").select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select("vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))


ORACLE = """
with recursive v as (
  select vec_id, [cast(c as double) for c in embedding] as x from embeddings),
ok as (
  select vec_id, [c / sqrt(list_inner_product(x, x)) for c in x] as u, len(x) as d
  from v where x is not null and list_bool_and([c is not null and isfinite(c) for c in x]) and list_bool_or([c <> 0 for c in x])),
linked as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.d = b.d and a.vec_id <> b.vec_id where list_inner_product(a.u, b.u) >= 0.95),
reach as (select vec_id, vec_id as root from v union select l.b, r.root from reach r join linked l on l.a = r.vec_id),
counts as (select a as vec_id, count(*) as n from linked group by a),
lowest as (select vec_id, min(root) as component_id from reach group by vec_id)
select v.vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, v.vec_id = component_id as kept
from v join lowest using (vec_id) left join counts using (vec_id)
"""
