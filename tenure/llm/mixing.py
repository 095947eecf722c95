"""Mixing sources to target weights by balanced sampling (the cube method).

Targets are words per source: a share of the total by weight, but at most
``cap`` times what the source has; the excess is shared again by weight. A
source that needs r times its words takes every document floor(r) times and
the fraction of r as an inclusion probability of one more copy. The cube
method turns the probabilities into 0 or 1: the flight phase moves three
documents at a time along the null space of two constraints, document total
and token total, so both totals stay exact, until at most two documents are
undecided. Documents are dealt to shards by a hash; each shard flies alone and
hands its two undecided documents a source to the next level, which flies
again, until one group a source is left. Landing then decides the last two
documents so that the token total errs least.

Rows with equal id, source and text are one document repeated: they count
together in every total and share one decision. Equal inputs give equal mixes.

Defined results: null text has size 0 and is never taken; the null source is a
source of its own, the last; a source without words gets target 0; extra
columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import random
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tenure.session import materialize

from .common import WORD, free_name, row_key

# Weights of the sources in order, repeating; the mix's size and
# the most words taken from a source, as shares of what there is.
WEIGHTS = (3, 1, 2)
AMOUNT = 1.5
CAP = 2.0
SHARD_ROWS = 50_000
FAN_IN = 500
SEED = 11


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, amount: float = AMOUNT, cap: float = CAP) -> DataFrame:
    """(source, source_size, target) from rows of (source, size).

    With caps c and weights w the fixed point of sharing the excess again is
    min(c, level * w): sources in order of c / w are capped until the level
    that spends the rest is below the next one's. One row per source, so the
    two ordered windows see as many rows as there are sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    per = per.withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(nth, F.lit(len(weights))) + 1).cast("int")))
    per = per.withColumn("c", F.col("source_size") * float(cap))
    order = Window.orderBy((F.col("c") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    total = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(total) * amount - F.coalesce(F.sum("c").over(before), F.lit(0.0))
    weight = F.sum("w").over(total) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("level", left / weight)
    # the first source that is not capped has the level; without one, all are capped
    level = F.min(F.when(F.col("c") > F.col("level") * F.col("w"), F.struct((F.col("c") / F.col("w")).alias("r"), "level"))).over(total)
    per = per.withColumn("target", F.coalesce(F.least("c", level["level"] * F.col("w")), F.col("c")))
    return per.select("source", "source_size", "target")


def fly(size: list[float], p: list[float], rng: random.Random) -> list[float]:
    """Probabilities after the flight: 0 or 1 but for at most two, sums of p and size * p unchanged."""
    out = list(p)
    live: list[int] = []
    for k in range(len(p)):
        if not 0.0 < out[k] < 1.0:
            continue
        live.append(k)
        while len(live) == 3 or len(live) == 2 and size[live[0]] == size[live[1]]:
            if len(live) == 3:
                a, b, c = (size[x] for x in live)
                u = (c - b, a - c, b - a)
                if not any(u):
                    u = (1.0, -1.0, 0.0)
            else:
                u = (1.0, -1.0)
            up = min((1 - out[x]) / v if v > 0 else out[x] / -v for x, v in zip(live, u, strict=True) if v)
            down = min(out[x] / v if v > 0 else (1 - out[x]) / -v for x, v in zip(live, u, strict=True) if v)
            step = up if rng.random() * (up + down) < down else -down
            still = []
            for x, v in zip(live, u, strict=True):
                q = out[x] + step * v
                q = 0.0 if q < 1e-9 else 1.0 if q > 1 - 1e-9 else q
                out[x] = q
                if 0.0 < q < 1.0:
                    still.append(x)
            if len(still) == len(live):  # rounding kept the mover off its wall: set it there
                x = min(still, key=lambda x: min(out[x], 1 - out[x]))
                out[x] = float(round(out[x]))
                still.remove(x)
            live = still
    return out


def land(size: list[float], p: list[float]) -> list[float]:
    """Decide the undecided few so that the token total errs least, then the document total."""
    open_ = [k for k, x in enumerate(p) if 0.0 < x < 1.0]
    want, many = sum(size[k] * p[k] for k in open_), sum(p[k] for k in open_)
    choices = [[(c >> j) & 1 for j in range(len(open_))] for c in range(1 << len(open_))]
    best = min(choices, key=lambda c: (abs(sum(size[k] * x for k, x in zip(open_, c, strict=True)) - want), abs(sum(c) - many)))
    out = list(p)
    for k, x in zip(open_, best, strict=True):
        out[k] = float(x)
    return out


def _fly_part(part: pd.DataFrame, last: bool, seed: int) -> pd.DataFrame:
    # long documents fly first, so the undecided last two are short and landing errs little
    part = part.sort_values(["source", "size", "key"], ascending=[True, False, True], kind="stable", na_position="last").reset_index(drop=True)
    p = part["p"].to_numpy(copy=True)
    source = part["source"].map(lambda s: "n" if s is None or s != s else "v" + s)
    for name, rows in source.groupby(source, sort=True).groups.items():
        rows = rows.to_numpy()
        rng = random.Random(f"{seed}:{name}:{part['shard'].iloc[0]}")
        size, q = part["size"].to_numpy()[rows].astype(float).tolist(), p[rows].tolist()
        q = fly(size, q, rng)
        p[rows] = land(size, q) if last else q
    part["p"] = p
    return part


STATE = "key string, source string, size bigint, p double, shard bigint"


def cube(units: DataFrame, count: int, seed: int = SEED, shard_rows: int = SHARD_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """(key, pick) for units of (key, source, size, p): pick is 0 or 1."""
    shards = max(1, -(-count // shard_rows))
    state = units.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(shards)))
    decided = []
    while True:
        last = shards == 1
        state = materialize(state.groupBy("shard").applyInPandas(partial(_fly_part, last=last, seed=seed), STATE), "flight")
        decided.append(state.where("p in (0.0, 1.0)").select("key", F.col("p").cast("int").alias("pick")))
        if last:
            break
        shards = -(-shards // fan_in)
        state = state.where("p > 0 and p < 1").withColumn("shard", F.pmod("shard", F.lit(shards)))
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = SEED) -> DataFrame:
    """One row per row of ``docs``: key, doc_id, source, size, source_size, target, repeats, taken."""
    doc_id, text, source = (F.col(f"`{c}`") for c in (id_col, text_col, source_col))
    rows = docs.select(
        row_key(doc_id, source, text).alias("key"), doc_id.alias("doc_id"), source.cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = materialize(rows, "sizes")
    per = materialize(targets(rows), "targets")
    per = per.withColumn("r", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    units = rows.groupBy("key", "source").agg(F.sum("size").cast("long").alias("size"))
    # `per` is a stored table of one row a source: Spark broadcasts it only if its file is small
    units = units.where("size > 0").join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    units = units.select("key", "source", "size", (F.col("r") - F.floor("r")).alias("p"))
    units = units.where("p > 1e-9")
    picks = cube(units, rows.count(), seed)
    out = rows.join(per.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s").join(picks, "key", "left")
    out = out.withColumn("repeats", F.when(F.col("size") > 0, F.floor("r") + F.coalesce("pick", F.lit(0))).otherwise(0).cast("int"))
    return out.select("key", "doc_id", "source", "size", "source_size", "target", "repeats", (F.col("size") * F.col("repeats")).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: rows of ``docs``, columns unchanged, each as often as it is taken (0, 1 or 2 times)."""
    repeats = mix(docs, id_col, text_col, source_col).where("repeats > 0").select(F.col("key").alias("k"), "repeats").distinct()
    repeats = materialize(repeats, "repeats")
    key, times, one = free_name(docs, "row_key"), free_name(docs, "repeats"), free_name(docs, "one")
    keyed = docs.withColumn(key, row_key(*(F.col(f"`{c}`") for c in (id_col, source_col, text_col))))
    repeats = repeats.select(F.col("k").alias(key), F.col("repeats").alias(times)).hint("merge")
    out = keyed.join(repeats, key).withColumn(one, F.explode(F.sequence(F.lit(1), F.col(times))))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
