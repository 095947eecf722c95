"""Search, whitening and the filter audit against brute force, and on odd rows."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenure.llm import bit_whitening, cross_polytope, filter_audit

VECTORS = "vec_id long, embedding array<double>, rank string, score int, d string"


def vectors_of(spark, rows):
    """Vectors with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", 0, "y") for i, v in rows], VECTORS)


# --- nearest vectors ------------------------------------------------------------------------


def brute_nearest(rows, every, nearest):
    """query row number -> [(score, id)] by the definition."""
    ok = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and len(v) and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    out = collections.defaultdict(list)
    for a, (i, v) in enumerate(ok):
        if i is not None and i % every == 0:
            all_ = [((v * w).sum(), j) for b, (j, w) in enumerate(ok) if b != a and len(w) == len(v)]
            all_.sort(key=lambda t: (-t[0], math.inf if t[1] is None else t[1]))
            out[i].append(all_[:nearest])
    return out


def found_nearest(spark, rows, every=10, **how):
    got = collections.defaultdict(dict)
    n = 0
    for r in cross_polytope.nearest(vectors_of(spark, rows), F.col("vec_id") % every == 0, **how).collect():
        got[r["query_id"]].setdefault(r["rank"], []).append((r["score"], r["vec_id"]))
        n += 1
    return got, n


def test_search_equals_brute_force_where_all_buckets_are_probed(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((240, 12))
    x[100:160] = x[100]  # a crowd of equal vectors
    x[160:170] *= 40  # other norms, hence other bands
    x[170:175] *= 1e-3
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got, _ = found_nearest(spark, rows, nearest=7, bucket_rows=1 << 40, block=64)
    for i, (want,) in brute_nearest(rows, 10, 7).items():
        assert [got[i][k + 1][0][1] for k in range(7)] == [j for _, j in want]
        assert np.allclose([got[i][k + 1][0][0] for k in range(7)], [s for s, _ in want], rtol=1e-14, atol=0)


def test_search_takes_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (10, [1.0, 0.0]), (3, [0.5, 0.5]), (None, [0.5, 0.5]), (None, None), (20, None), (30, [0.0, 0.0]), (40, [float("nan"), 1.0]),
            (50, [None, 1.0]), (60, [float("inf"), 1.0]), (70, []), (80, [2.0]), (81, [-2.0]), (90, [1e200, 1e200]), (91, [1e-200, 1e-200])]
    got, n = found_nearest(spark, rows)
    want = brute_nearest(rows, 10, 20)
    assert n == sum(len(a) for each in want.values() for a in each)
    assert set(got) == {0, 10, 80, 90}
    for i, answers in want.items():
        for k in range(len(answers[0])):
            assert sorted(got[i][k + 1], key=str) == sorted([(a[k][0], a[k][1]) for a in answers], key=str)
    assert got[80][1] == [(-4.0, 81)]
    for few in ([], [(0, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(0, None)]):
        assert found_nearest(spark, few)[1] == 0


@pytest.mark.parametrize("dense", [False, True])
def test_search_recall_with_production_parameters(spark, dense):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((6000, 48))
    if dense:  # a third of all vectors in one tight group, more than a block
        x[:2000] = 6 * rng.standard_normal(48) + 0.3 * rng.standard_normal((2000, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(int(k), v.tolist()) for k, v in zip(rng.permutation(6000), x, strict=True)]
    got, n = found_nearest(spark, rows, every=20, block=500)
    ids = np.array([i for i, _ in rows])
    asked = np.flatnonzero(ids % 20 == 0)
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -9
    top = np.argsort(-s, 1)[:, :20]
    hits = sum(len({r[0][1] for r in got[int(ids[a])].values()} & set(ids[top[k]].tolist())) for k, a in enumerate(asked))
    assert n == 20 * len(asked)
    assert hits >= 0.92 * n


def test_search_serves_single_precision_and_repeatable(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(rng.standard_normal((400, 16)))], "vec_id int, embedding array<float>")
    runs = [sorted(cross_polytope.nearest(d, F.col("vec_id") % 5 == 0).collect()) for d in (df, df.repartition(7))]
    assert runs[0] == runs[1] and len(runs[0]) == 80 * 20


def test_hadamard_is_orthonormal_and_probes_are_in_order():
    h = cross_polytope.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)
    table = cross_polytope.Polytopes(10, [16, 4], 3)
    x = np.random.default_rng(0).standard_normal((50, 10))
    probes = table.probes(x, 20)
    assert (probes[:, 0] == table.code(x)).all()
    assert all(len(set(p)) == 20 for p in probes.tolist())
    everything = table.probes(x, 10_000)
    assert everything.shape[1] == 32 * 8 and (everything[:, :20] == probes).all()


# --- whitening ------------------------------------------------------------------------------


def brute_space(x):
    """Exact covariance of the distinct rows of whole numbers, in rationals."""
    fit = [list(r) for r in sorted({tuple(r) for r in x.tolist()})]
    n, d = len(fit), len(fit[0])
    s = [sum(r[i] for r in fit) for i in range(d)]
    v = [[Fraction(sum((n * r[i] - s[i]) * (n * r[j] - s[j]) for r in fit), n**3) for j in range(d)] for i in range(d)]
    return n, s, v


def whitened_rows(spark, rows):
    out = collections.defaultdict(list)
    for r in bit_whitening.whitened(vectors_of(spark, rows)).collect():
        out[r["vec_id"]].append(r)
    return {k: sorted(v, key=lambda r: r["component"]) for k, v in out.items()}


def test_scatter_is_exact_at_every_width():
    rng = np.random.default_rng(4)
    for top, n in ((1, 5), (2, 64), (90, 200), (1 << 20, 130), (1 << 45, 70)):
        y = rng.integers(-top, top + 1, (n, 9))
        sums, products = bit_whitening.scatter(y)
        plain = [[int(v) for v in row] for row in y.tolist()]
        assert sums == [sum(r[i] for r in plain) for i in range(9)]
        assert products == [[sum(r[i] * r[j] for r in plain) for j in range(i, 9)] for i in range(9)]


def test_whitening_equals_the_definition(spark):
    rng = np.random.default_rng(8)
    values = rng.standard_normal((300, 20)) @ np.diag(np.linspace(3, 0.2, 20))
    rows = [(k, v.tolist()) for k, v in enumerate(values)] + [(1000, values[3].tolist()), (1001, values[3].tolist()), (1001, values[4].tolist())]
    got = whitened_rows(spark, rows)
    x = np.floor(64 * values).astype(np.int64) + 1_000_000
    n, s, v = brute_space(x)
    e, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in v]))
    e, vectors = e[::-1][:16], vectors[:, ::-1][:, :16]
    want = (x - np.array(s) / n) @ vectors / np.sqrt(e)
    mine = np.array([[r["whitened"] for r in got[k]] for k in range(300)])
    assert np.allclose(mine * np.sign((mine * want).sum(0)), want, atol=1e-8)
    trace = float(sum(v[i][i] for i in range(20)))
    for k in range(300):
        assert [r["component"] for r in got[k]] == list(range(1, 17)) and {r["n"] for r in got[k]} == {n}
        assert {r["deviation"] for r in got[k]} == {sum((n * int(c) - t) ** 2 for c, t in zip(x[k], s, strict=True))}
        assert np.allclose([r["explained"] for r in got[k]], e / trace, rtol=1e-9)
        assert got[k][0]["identity_error"] < 1e-9
    assert [r["whitened"] for r in got[1000]] == [r["whitened"] for r in got[3]] and len(got[1001]) == 32
    spread = mine - mine.mean(0)
    assert np.abs(spread.T @ spread / n - np.eye(16)).max() < 1e-9


def test_whitening_takes_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 2.0]), (None, [5.0, 2.0]), (3, None), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("-inf"), 1.0]), (7, []),
            (8, [0.0, 2.0]), (9, [7.0]), (10, [1.0, 2.0, 1e13]), (11, [4.0, 5.0, -1e13])]
    got = whitened_rows(spark, rows)
    assert set(got) == {1, 2, None, 8, 9, 10, 11}
    assert len(got[1]) == 4 and got[1][0]["n"] == 4  # two components, twice; 1, 3, 5 and 0 fitted once each
    assert [r["whitened"] is None for r in got[2]] == [False, True] and got[2][0]["identity_error"] < 1e-9  # the second dimension never varies
    assert [r["explained"] for r in got[2]] == [1.0, 0.0]
    assert len(got[9]) == 1 and got[9][0]["whitened"] is None and got[9][0]["deviation"] == 0 and got[9][0]["explained"] is None
    wide = [(2 * int(64 * a) - int(64 * a) - int(64 * b)) for a, b in ((1.0, 4.0), (2.0, 5.0), (1e13, -1e13))]
    assert got[10][0]["deviation"] is None and int(got[10][0]["deviation_text"]) == sum(c * c for c in wide)
    assert whitened_rows(spark, []) == {} and whitened_rows(spark, [(1, None)]) == {}
    with pytest.raises(Exception, match="too large for an exact whole number"):
        whitened_rows(spark, [(1, [1e300])])


# --- filter audit ---------------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_audit(docs, labels):
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(first.get(t or "", math.inf), i)
    parts = collections.defaultdict(list)
    for i, t, part in docs:
        t = t or ""
        w = WORD.findall(t)
        failed = {c for c, bad in zip("ABCDE", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), any(c in "#$%&*|" for c in t),
                                              i is not None and first[t] < i), strict=True) if bad}
        parts[part or ""].append((failed, any(j == i and q == 1 for j, q, _ in labels if i is not None), any(j == i and x == 1 for j, _, x in labels if i is not None)))
    out = {}
    for part, rows in parts.items():
        shares = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                out_, stay = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                failing = sum(f in r[0] for r in rows)
                out[part, order, step] = [len(stay), len(out_), failing - len(out_), sum(r[0] == {f} for r in rows), sum(r[1] for r in out_), sum(r[2] for r in out_)]
                shares[f] += len(out_)
                left = stay
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shares[f])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows(spark, docs, labels):
    d = spark.createDataFrame([(i, t, p, "x", 1) for i, t, p in docs], "doc_id long, text string, source string, part string, failed int")
    m = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = filter_audit.audit(d, m).collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in rows}
    assert len(out) == len(rows)
    return out


def test_audit_equals_walking_every_order(spark):
    rng = random.Random(6)

    def text():
        n = rng.choice([3, 150, 210, 260])
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4 if rng.random() < 0.5 else 1))) for _ in range(n)]
        t = rng.choice([" ", "\n", "  "]).join(words)
        if rng.random() < 0.3:
            t += " " + "XY" * rng.randint(1, 40)
        return t + rng.choice(["", "", " #", " a|b", "é€"])

    texts = [text() for _ in range(40)]
    docs = [(k, rng.choice(texts), rng.choice(["a", "b", None])) for k in range(120)]
    docs += [(500, None, "a"), (501, "", "a"), (None, "", ""), (None, texts[0], "b"), (7, docs[7][1], "b"), (7, docs[7][1], docs[7][2]), (600, "word " * 200_000, None), (601, "word " * 200_000, "c")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 120, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (600, 1, 1), (9999, 1, 1)]
    assert audit_rows(spark, docs, labels) == brute_audit(docs, labels)
    assert audit_rows(spark, [], labels) == {}
    assert audit_rows(spark, docs[:5], []) == brute_audit(docs[:5], [])


def test_least_squares_gives_the_shapley_value():
    share = filter_audit.shapley_map()
    rng = random.Random(2)
    v = [0, *(rng.randint(0, 10**12) for _ in range(31))]
    for i in range(5):
        want = sum(Fraction(math.factorial(s.bit_count()) * math.factorial(4 - s.bit_count()), 120) * (v[s | 1 << i] - v[s]) for s in range(32) if not s >> i & 1)
        assert sum(w * x for w, x in zip(share[i], v, strict=True)) == want
