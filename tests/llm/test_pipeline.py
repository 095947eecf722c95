"""The stages in order, each on what the one before kept."""

import random
from collections import Counter

import corpus_pipeline
from tenure.llm.common import table
from tenure.session import materialize

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = table(spark, SF, "documents")
    columns, ids = docs.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.columns == columns
        now = {r["doc_id"] for r in docs.select("doc_id").collect()}
        assert now and (ids is None or now <= ids)
        ids = now
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["doc_id"] for r in placed} == ids
    assert corpus_pipeline.run(spark, SF).count() == len(placed)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(n))


def odd_documents(spark):
    """Null, empty and blank texts, null and repeated ids, repeated rows, near copies, a long text, two languages."""
    rng = random.Random(12)
    one, two = words(rng, 90, "abcdef"), words(rng, 90, "uvwxyz")
    near = one.split()
    near[40] = "changed"
    rows = [(1, None, "aa", "s"), (1, None, "aa", "s"), (2, "", None, None), (2, "", None, None), (3, " \n\t", "aa", "s"), (4, "12 34 !?", "aa", "s"), (None, words(rng, 60, "abcdef"), "aa", None),
            (10, one, "aa", "s"), (10, one, "aa", "s"), (10, two, "bb", "t"), (11, " ".join(near), "aa", "s"), (12, one, "aa", "t"), (None, one, "aa", "t"), (-5, one, "aa", None),
            (13, "\n".join(words(rng, 40, "abcdef") for _ in range(300)), "aa", "s"), (14, words(rng, 50, "abcdef") + " " + words(rng, 50, "uvwxyz"), None, "t")]
    rows += [(100 + k, words(rng, 30, "abcdef" if k % 2 else "uvwxyz"), "aa" if k % 2 else "bb", "s") for k in range(40)]
    return spark.createDataFrame([(i, t, la, so, len(t or "")) for i, t, la, so in rows], SCHEMA), rows


def test_every_stage_takes_odd_rows_and_an_empty_table(spark):
    docs, rows = odd_documents(spark)
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
    for name, stage in corpus_pipeline.STAGES[:-1]:
        alone = stage(spark, docs, SF)
        assert alone.columns == docs.columns and alone.count() > 0, name
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), name)
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert placed.where("piece = 0").count() == docs.count()


def test_language_stage_keeps_all_that_the_method_names(spark):
    docs, rows = odd_documents(spark)
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.STAGES[0][1](spark, docs, SF).collect())
    assert kept == Counter((i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t))  # mixed ones too


def test_one_row_of_each_near_group_stays(spark):
    docs, rows = odd_documents(spark)
    kept = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.STAGES[2][1](spark, docs, SF).collect())
    text = {(i, t): {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := (t or "").lower().split()) else set() for i, t, *_ in rows}

    def linked(a, b):
        return bool(text[a]) and 100 * len(text[a] & text[b]) >= 75 * len(text[a] | text[b])

    groups, left = [], list(dict.fromkeys((i, t) for i, t, *_ in rows))
    while left:  # components by the definition
        group, todo = [], [left.pop(0)]
        while todo:
            a = todo.pop()
            group.append(a)
            near = [b for b in left if linked(a, b)]
            left = [b for b in left if b not in near]
            todo += near
        groups.append(group)
    want = Counter()
    for group in groups:
        if text[group[0]]:
            want[min(group, key=lambda d: (d[0] is None, d[0] or 0, d[1]))] += 1
        else:
            want[group[0]] += sum((i, t) == group[0] for i, t, *_ in rows)
    assert kept == want
    assert kept[10, next(t for i, t, *_ in rows if i == 10 and t[0] in "uvwxyz")] == 1  # its id goes with another text
