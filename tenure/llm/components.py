"""Connected components of a table of links, and of links inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenure.session import materialize

#: Links that one task contracts at once (about 150 MB in numpy).
TASK_LINKS = 2_000_000


def merge(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite i[k] and j[k] in place; ``label`` points each member to the smallest of its set."""
    while True:
        a, b = label[i], label[j]
        open_ = a != b
        if not open_.any():
            return
        i, j = i[open_], j[open_]
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while True:
            up = label[label]
            if (up == label).all():
                break
            label[:] = up


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one partition as stars: (member, smallest member) of each local set."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if parts:
        u, v = (np.concatenate(x) for x in zip(*parts, strict=True))
        nodes, at = np.unique(np.concatenate((u, v)), return_inverse=True)
        label = np.arange(len(nodes))
        merge(label, at[: len(u)], at[len(u) :])
        out = np.flatnonzero(label != np.arange(len(nodes)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[label[out]])], names=["u", "v"])


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every linked node but the roots; ``links`` has long columns a, b.

    Partitions first contract their own links to stars; there are as many
    partitions as TASK_LINKS links each need, by an exact count. Links that fit
    one partition are thereby done. Otherwise, while the whole is not yet a set
    of stars, large-star and small-star steps alternate: each node's smallest
    neighbour comes from an aggregate with a partial step, then a join on the
    node (split by AQE where a node has very many links). Every round is
    written to the shared folder, so lineage stays short and a lost executor
    redoes one round. The links stay on the executors; the driver sees counts.
    """
    edges = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    n = links.count()
    while True:
        parts = max(1, -(-n // TASK_LINKS))
        edges = edges.coalesce(parts).mapInArrow(_contract, "u bigint, v bigint")
        if parts == 1:  # one partition's stars are those of all links
            return materialize(edges, "components").select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = materialize(edges.distinct(), "components")
        n = edges.count()
        per = edges.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
        if per.where("n > 1").isEmpty() and edges.join(edges.select(F.col("v").alias("u")), "u", "left_semi").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        both = edges.select(F.col("u").alias("a"), F.col("v").alias("b")).unionAll(edges.select(F.col("v").alias("a"), F.col("u").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = small.select("u", F.col("m").alias("v")).unionAll(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
