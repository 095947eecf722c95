"""What each of five filters removes, in every order, and its Shapley share.

Each document gets the set of filters it fails. Per part (source) these sets
are tabulated as the removals of all 32 coalitions: v(S) is the number of
documents that fail at least one filter of S, for all documents, for the good
and for the toxic ones. Everything else follows from that table:

* a filter's step in an order removes v(before + filter) - v(before);
* its Shapley value is the exact solution of the constrained least squares
  problem: minimise the sum over S of w(S) (v(S) - sum of phi in S)^2 subject
  to sum of phi = v(all), with the Shapley kernel's weights. The normal
  equations are the same for every part, so they are solved once, in
  rationals, as a map from the 32 removals; a part's values are then whole
  sums over that map's numerators.

Texts are read once, in a map that keeps the failed sets and a 128-bit digest.
"Identical to a smaller doc_id's text" needs no join of rows: rows are counted
by (text, set, part, id), then by (text, set, part) with the smallest id and
its count, so a text on a third of all rows is a few rows a task before it is
shuffled; of these groups those that hold their text's smallest id are found.

Defined results: null texts are empty; an empty text fails A, and E if a
smaller id has an empty or null text; a null doc_id is smaller than none and
has no smaller one; rows repeated with one id do not make each other fail E;
a null source is the part '' (with sources that are ''); documents without a
label are neither good nor toxic, and any label row of an id with 1 makes it
so; an empty table has no part and gives no row.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenure.session import materialize

from .common import as_binary, chunks, utf8

FILTERS = "ABCDE"
EVERY = (1 << len(FILTERS)) - 1
# The limits of the filters.
MIN_WORDS = 200
SYMBOLS = re.compile(rb"[#$%&*|]")
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUATION = bytes(range(0x80, 0xC0))

MEASURES = ("all", "good", "toxic")


def failed_by_text(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * capitals > 2 * points) << 2
        | (SYMBOLS.search(text) is not None) << 3
    )


def shapley_map(n: int = len(FILTERS)) -> list[list[Fraction]]:
    """Row i: the weights of v(0), v(1), ... v(all) in filter i's Shapley value.

    Solves the efficiency-constrained normal equations
    [sum w z z'  1; 1' 0] [phi; multiplier] = [sum w z v(S); v(all)]
    for every unit vector of removals at once, by elimination in rationals.
    """
    full = (1 << n) - 1
    left = [[Fraction(0)] * (n + 1) for _ in range(n + 1)]
    right = [[Fraction(0)] * (full + 1) for _ in range(n + 1)]
    for s in range(1, full):
        size = s.bit_count()
        weight = Fraction(n - 1, math.comb(n, size) * size * (n - size))
        members = [i for i in range(n) if s >> i & 1]
        for i in members:
            right[i][s] += weight
            for j in members:
                left[i][j] += weight
    for i in range(n):
        left[i][n] = left[n][i] = Fraction(1)
    right[n][full] = Fraction(1)
    rows = [a + b for a, b in zip(left, right, strict=True)]
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [x - rows[r][c] * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [rows[i][n + 1 :] for i in range(n)]


def failed_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc, part, digest, failed) per row; ``failed`` has the bits of A to D."""
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc"), part, F.col(f"`{text_col}`").alias("text"))
    id_type = rows.schema["doc"].dataType
    out = T.StructType([T.StructField("doc", id_type), T.StructField("part", T.StringType()), T.StructField("digest", T.BinaryType()), T.StructField("failed", T.IntegerType())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            texts = utf8(batch)
            digest = pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary())
            failed = pa.array([failed_by_text(t) for t in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), digest, failed], names=["doc", "part", "digest", "failed"])

    return as_binary(rows, "doc", "part").mapInArrow(judge, out)


def failed_counts(sets: DataFrame, labels: DataFrame, label_id: str = "doc_id") -> DataFrame:
    """(part, failed, good, toxic, docs): documents by their whole failed set, E included."""
    marks = labels.where(F.col(f"`{label_id}`").isNotNull()).groupBy(F.col(f"`{label_id}`").alias("doc"))
    marks = marks.agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = sets.join(marks, "doc", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")})
    kind = ["part", "failed", "good", "toxic"]
    by_id = marked.groupBy("digest", *kind, "doc").agg(F.count(F.lit(1)).alias("n"))
    groups = by_id.groupBy("digest", *kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        F.min("doc").alias("doc"),
        F.min_by(F.when(F.col("doc").isNotNull(), F.col("n")), "doc").alias("n_least"),
    )
    groups = materialize(groups, "text-groups")
    least = groups.groupBy("digest").agg(F.min("doc").alias("doc"))
    first = groups.join(least, ["digest", "doc"], "left_semi").groupBy(*kind).agg(F.sum("n_least").alias("n_first"))
    cells = groups.groupBy(*kind).agg(F.sum("n").alias("n"), F.sum("n_null").alias("n_null")).join(first, kind, "left")
    unique = F.col("n_null") + F.coalesce("n_first", F.lit(0))
    same_text = 1 << FILTERS.index("E")
    two = F.explode(F.array(F.struct(F.col("failed"), unique.alias("docs")), F.struct((F.col("failed") + same_text).alias("failed"), (F.col("n") - unique).alias("docs"))))
    return cells.select("part", "good", "toxic", two.alias("cell")).select("part", "cell.failed", "good", "toxic", "cell.docs")


def coalition_removals(counts: DataFrame) -> DataFrame:
    """Per part: ``docs``, and arrays ``all``, ``good``, ``toxic`` of the 32 coalitions' removals."""
    when = {"all": F.lit(True), "good": F.col("good") == 1, "toxic": F.col("toxic") == 1}
    sums = [F.sum("docs").alias("docs")]
    for m in MEASURES:
        per = [F.sum(F.when(when[m] & (F.col("failed").bitwiseAND(s) != 0), F.col("docs")).otherwise(0)) for s in range(EVERY + 1)]
        sums.append(F.array(*per).alias(m))
    return counts.groupBy("part").agg(*sums)


def _ints(values) -> Column:
    return F.lit(list(values)).cast("array<bigint>")


def order_steps(removals: DataFrame) -> DataFrame:
    """Every part's 120 orders with five steps each, from its 32 removals."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    letters = [c for order in orders for c in order]
    own = [1 << FILTERS.index(c) for c in letters]
    before = [sum(own[k - k % 5 : k]) for k in range(len(own))]

    share = shapley_map()
    scale = math.lcm(*(w.denominator for row in share for w in row))
    orders_n = math.factorial(len(FILTERS))

    def shapley(i: int) -> Column:  # times the number of orders, hence whole
        total = F.lit(0).cast("bigint")
        for s, w in enumerate(share[i]):
            if w:
                total = total + F.get("all", F.lit(s)) * F.lit(int(w * scale) * orders_n).cast("bigint")
        return F.call_function("div", total, F.lit(scale).cast("bigint"))

    values = removals.withColumn("values", F.array(*[shapley(i) for i in range(len(FILTERS))]))
    rows = values.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(own) - 1))).alias("k"))
    rows = rows.select("*", F.get(_ints(own), F.col("k")).cast("int").alias("own"), F.get(_ints(before), F.col("k")).cast("int").alias("before"))
    after = F.col("own") + F.col("before")

    def gain(m: str) -> Column:
        return F.get(m, after) - F.get(m, F.col("before"))

    return rows.select(
        "part",
        F.get(F.lit(orders), F.floor(F.col("k") / 5).cast("int")).alias("filter_order"),
        (F.col("k") % 5 + 1).cast("int").alias("step"),
        (F.col("docs") - F.get("all", after)).alias("kept"),
        gain("all").alias("removed"),
        (F.get("all", F.col("own")) - gain("all")).alias("redundant"),
        (F.get("all", F.lit(EVERY)) - F.get("all", F.lit(EVERY) - F.col("own"))).alias("unique_fails"),
        gain("good").alias("good_lost"),
        gain("toxic").alias("toxic_lost"),
        F.get("values", F.get(_ints([FILTERS.index(c) for c in letters]), F.col("k")).cast("int")).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole audit: one row per part, filter order and step."""
    return order_steps(coalition_removals(failed_counts(failed_sets(docs), labels)))


ORACLE = """
with words as (
  select doc_id, coalesce(cast(source as varchar), '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
first_ids as (select t, min(doc_id) as first_id from words group by t),
marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
          from labels where doc_id is not null group by doc_id),
docs as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
         (case when len(w) < 200 then 'A' else '' end)
         || (case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end)
         || (case when 100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t) then 'C' else '' end)
         || (case when regexp_matches(d.t, '[#$%&*|]') then 'D' else '' end)
         || (case when coalesce(d.doc_id > f.first_id, false) then 'E' else '' end) as failed
  from words d join first_ids f on d.t = f.t left join marks m on d.doc_id = m.doc_id),
cells as (select part, failed, good, toxic, count(*) as n from docs group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select a.x || b.x || c.x || d.x || e.x as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select filter_order, s as step, filter_order[s] as own, filter_order[1:s - 1] as earlier
          from orders, (select unnest([1, 2, 3, 4, 5]) as s)),
judged as (
  select c.part, s.filter_order, s.step, s.own, c.n, c.good, c.toxic, c.failed,
         contains(c.failed, s.own) as fails,
         c.failed <> '' and regexp_matches(s.earlier, '[' || case when c.failed = '' then 'x' else c.failed end || ']') as gone
  from cells c, steps s),
counted as (
  select part, filter_order, step, own,
         sum(case when not gone and not fails then n else 0 end) as kept,
         sum(case when not gone and fails then n else 0 end) as removed,
         sum(case when gone and fails then n else 0 end) as redundant,
         sum(case when failed = own then n else 0 end) as unique_fails,
         sum(case when not gone and fails and good = 1 then n else 0 end) as good_lost,
         sum(case when not gone and fails and toxic = 1 then n else 0 end) as toxic_lost
  from judged group by part, filter_order, step, own)
select part, filter_order, cast(step as integer) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, own) as bigint) as shapley
from counted
"""
