"""Secret scans with corpus-wide ownership frequency, as DataFrame expressions.

Candidates are found by patterns in each whole text, with their positions. The
values' hashes are then counted over the corpus by distinct repositories and
owners: a value that several owners or many repositories have is a copied
example; one that a single owner has in few repositories, and that looks
random, is taken to be live. Further kinds of
tokens are reported only where ownership calls them live; the base kinds are
always reported.

Both counts are aggregates with partial steps over (value, owner or repository), so a value
found in a third of all rows stays small, and the join back to the documents
is split by AQE where one value is frequent. Texts are read once; only spans
and hashes are written and shuffled.

A span is the whole match, in code points, end exclusive. Defined results: null
text is empty and has no spans; a null owner or repository is one of its own; repeated
rows are one document for the counts and rows of their own in the result; an
empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenure.session import materialize

from .common import row_key

# Kind -> (pattern, group that is the secret, least characters of
# that group, a text that every match contains or a pattern for a first look).
BASE = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
FIRST_LOOK = {"assign": r"(?i:password|passwd|secret|token|api_?key)", "access": "AKIA", "hex": "[0-9a-f]{16}"}
MORE = {
    "github": (r"(?<![A-Za-z0-9])gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    "slack": (r"(?<![A-Za-z0-9])xox[abprs]-[A-Za-z0-9-]{10,}", 0, 15),
    "jwt": (r"(?<![A-Za-z0-9])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 28),
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----[^-]+-----END [A-Z ]*PRIVATE KEY-----", 0, 60),
    "bearer": (r"(?i:bearer)\x20+([A-Za-z0-9+/_.=-]{20,})", 1, 20),
    "url": (r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:([^\s/@]{8,64})@", 1, 8),
}
MORE_LOOK = r"gh[opsur]_|xox[abprs]-|eyJ|-----BEGIN|(?i:bearer) |://[^\s:/@]{1,64}:"
KINDS = (*BASE, *MORE)
#: A value with at least this many owners is a copied example.
EXAMPLE_OWNERS = 3
#: A value in at least this many repositories is a copied example, even with one owner.
EXAMPLE_REPOS = 10
#: Least distinct characters of a value that looks random.
DISTINCT_CHARACTERS = 8


def running(lengths: Column) -> Column:
    """Inclusive running sums of an array, in log2(n) passes of doubling reach."""
    def reach(sums: Column, k: Column) -> Column:
        by = F.pow(F.lit(2.0), k).cast("int")
        return F.transform(sums, lambda x, i: x + F.when(i >= by, F.get(sums, i - by)).otherwise(0))

    steps = F.when(F.size(lengths) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, lengths, reach)


def matches(rows: DataFrame, kind: str, pattern: str, group: int, least: int, look: str | None) -> DataFrame:
    """Adds column ``kind``: spans (kind, start, end, secret) of the matches that are long enough.

    The pattern's matches and the text between them (a split by the same
    pattern) alternate, so running sums of their lengths give the positions.
    """
    text = F.col("text")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if look:
        test = text.contains(look) if look.isalnum() else text.rlike(look)
        found = F.when(test, found)
    rows = rows.withColumn("_m", found)
    some = F.size("_m") > 0
    rows = rows.withColumn("_gap", F.when(some, F.transform(F.split(text, pattern, -1), F.length)))
    rows = rows.withColumn("_s", F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.col("_m"))
    rows = rows.withColumn("_s", F.when(some, F.col("_s"))) if not group else rows
    both = F.zip_with("_m", F.slice("_gap", 1, F.greatest(F.size("_m"), F.lit(1))), lambda m, g: F.length(m) + g)
    rows = rows.withColumn("_end", F.when(some, running(both)))
    spans = F.transform(
        "_m",
        lambda m, i: F.struct(F.lit(kind).alias("kind"), (F.get("_end", i) - F.length(m)).alias("start"), F.get("_end", i).alias("end"), F.get("_s", i).alias("secret")),
    )
    kept = F.filter(spans, lambda s: F.length(s["secret"]) >= least)
    return rows.withColumn(kind, F.when(some, kept)).drop("_m", "_gap", "_s", "_end")


_SPAN = "array<struct<kind:string,start:int,end:int,secret:string>>"


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """key, doc_id, owner, repo and ``found``: all candidate spans by start, then kind."""
    doc_id, text, owner = (F.col(f"`{c}`") for c in (id_col, text_col, owner_col))
    repo = F.col(f"`{repo_col}`").cast("string") if repo_col else row_key(doc_id, text)
    rows = docs.select(row_key(doc_id, owner, text).alias("key"), doc_id.alias("doc_id"), owner.cast("string").alias("owner"), repo.alias("repo"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))
    for kind, (pattern, group, least) in BASE.items():
        rows = matches(rows, kind, pattern, group, least, FIRST_LOOK[kind])
    rows = rows.withColumn("_more", F.col("text").rlike(MORE_LOOK))
    for kind, (pattern, group, least) in MORE.items():
        rows = matches(rows.withColumn("_whole", F.col("text")).withColumn("text", F.when(F.col("_more"), F.col("text"))), kind, pattern, group, least, None)
        rows = rows.withColumn("text", F.col("_whole")).drop("_whole")
    every = F.flatten(F.array(*[F.coalesce(F.col(k), F.array().cast(_SPAN)) for k in KINDS]))
    ranked = F.transform(
        every,
        lambda s: F.struct(
            s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).cast("int").alias("rank"), s["end"].alias("end"),
            s["kind"].alias("kind"), F.sha2(s["secret"], 256).alias("hash"),
            (F.size(F.array_distinct(F.split(s["secret"], ""))) > DISTINCT_CHARACTERS).alias("random"),
        ),
    )
    return rows.select("key", "doc_id", "owner", "repo", F.sort_array(ranked).alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """hash, n_owners, n_repos of every candidate value."""
    one = found.select("owner", "repo", F.explode(F.array_distinct(F.col("found.hash"))).alias("hash"))
    # structs, so that null is an owner or repository too
    return one.groupBy("hash").agg(F.count_distinct(F.struct("owner")).alias("n_owners"), F.count_distinct(F.struct("repo")).alias("n_repos"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str | None = None) -> DataFrame:
    """One row per document: counts and digest of the base spans, all spans, how many values are live or examples,
    and the most owners and repositories that one of its values has.

    Without ``repo_col`` each document is a repository of its own.
    """
    found = materialize(candidates(docs, id_col, text_col, owner_col, repo_col), "candidates")
    known = ownership(found.where(F.size("found") > 0))
    # hashes shared by documents decide; one row per document and span goes to the join
    one = found.where(F.size("found") > 0).select("key", "found").dropDuplicates(["key"]).select("key", F.explode("found").alias("s"))
    one = one.select("key", "s", F.col("s.hash").alias("hash")).join(known, "hash")
    example = (F.col("n_owners") >= EXAMPLE_OWNERS) | (F.col("n_repos") >= EXAMPLE_REPOS)
    live = F.col("s.random") & (F.col("n_owners") == 1) & ~example
    base = F.col("s.rank") <= len(BASE)
    spans = one.groupBy("key").agg(
        F.sort_array(F.collect_list(F.when(base | live, F.col("s")))).alias("all_spans"),
        F.sum(live.cast("long")).alias("n_live"),
        F.sum(example.cast("long")).alias("n_example"),
        F.max("n_owners").alias("most_owners"),
        F.max("n_repos").alias("most_repos"),
    )
    rows = found.select("key", "doc_id", F.filter("found", lambda s: s["rank"] <= len(BASE)).alias("base")).join(spans, "key", "left")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias("n_" + k)
    zero = F.lit(0).cast("long")
    return rows.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), F.coalesce(_joined(F.col("all_spans")), F.lit("")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"), F.coalesce("most_owners", zero).alias("most_owners"),
        F.coalesce("most_repos", zero).alias("most_repos"),
    )
