"""Toxic spans by a linear-chain conditional random field.

Tokens are runs of letters. A token carries hashed features of its own lower
case form (the word, its beginnings of three to six letters, its last three);
two states (clean, toxic) are chained by transition weights. The CRF is
trained on labelled tokens by gradient steps on the exact likelihood, with
forward-backward marginals. Token labels come from labelled documents: words
and word beginnings that occur in far more different words of toxic documents
than their rate in clean ones lets expect are markers; tokens with a marker in
toxic documents are labelled toxic, all others clean. A document's score is a
logistic function, fitted on the same rows, of two things the marginals give:
the expected number of different toxic words and the probability that any
token is toxic. Spans are the tokens more likely toxic than not, in documents
whose score passes the threshold.

Forward-backward runs in numpy over many documents at once: the tokens of a
batch form one chain that restarts at each document, cut into blocks whose 2x2
products are computed side by side. The result is the exact marginal.

Training reads a bounded sample of labelled ids (``max_toxic``, ``max_clean``),
one text of each; scoring is a map over all documents and whole texts, without
a shuffle.

Defined results: null, empty and letterless texts have no tokens and get the
score of a document without toxic tokens; without labelled toxic rows every
score is 0; ids may be of any type; of an id's several texts the least by hash
is learned from; repeated rows get one row each; other columns are never read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_binary, chunks, held_out, utf8

MAX_TOXIC = 1000
MAX_CLEAN = 1600
FEATURE_BITS = 17
BLOCK = 128
THRESHOLD = 0.3
STEPS = 40
CACHE_WORDS = 400_000
FAINT = 0.02  # tokens less likely toxic than this are not counted as words

TOKEN = re.compile(r"[^\W\d_]+")


def beginnings(word: str) -> list[str]:
    """The word and its beginnings: what can mark a toxic document."""
    return ["=" + word, *(word[:n] for n in range(3, 7) if len(word) >= n)]


def features(word: str) -> list[int]:
    """Hashed features of a lower-cased word; always the same number of them."""
    w = word + "$"
    parts = ["w" + w, *("p" + w[:n] for n in range(3, 7)), "s" + w[-4:]]
    return [zlib.crc32(p.encode()) & ((1 << FEATURE_BITS) - 1) for p in parts]


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1 << FEATURE_BITS, np.float32))
    bias: float = -4.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    logit: np.ndarray = field(default_factory=lambda: np.array([-30.0, 0.0, 0.0]))
    markers: frozenset = frozenset()


def forward_backward(emit: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray):
    """Exact marginals of chains laid end to end.

    ``emit``: weight of the toxic over the clean state at each token; ``first``:
    True at each chain's first token. Returns the marginal of the toxic state,
    the log probability that a token is clean given that the token before is,
    and the expected transition counts (within chains) and starts.
    """
    n = len(emit)
    size = -(-n // BLOCK) * BLOCK
    e = np.clip(emit, -30, 30)
    w0 = np.exp(-np.maximum(e, 0))
    w1 = np.exp(e - np.maximum(e, 0))
    A = np.exp(trans - trans.max())
    S = np.exp(start - start.max())
    m = np.empty((4, size))
    m[:, n:] = 0.5
    for k, (i, j) in enumerate(((0, 0), (0, 1), (1, 0), (1, 1))):
        m[k, :n] = np.where(first, S[j], A[i, j]) * (w1 if j else w0)
    m00, m01, m10, m11 = (x.reshape(-1, BLOCK) for x in m)
    blocks = len(m00)
    p = np.zeros((4, blocks))
    p[0] = p[3] = 1
    for k in range(BLOCK):
        a, b, c, d = m00[:, k], m01[:, k], m10[:, k], m11[:, k]
        q = np.stack((p[0] * a + p[1] * c, p[0] * b + p[1] * d, p[2] * a + p[3] * c, p[2] * b + p[3] * d))
        p = q / q.max(0)
    f0, f1 = np.empty(blocks), np.empty(blocks)
    x = 0.5
    for k, (a, b, c, d) in enumerate(p.T.tolist()):
        f0[k], f1[k] = x, 1 - x
        u, v = x * a + (1 - x) * c, x * b + (1 - x) * d
        x = u / (u + v)
    g0, g1 = np.empty(blocks), np.empty(blocks)
    x = 0.5
    for k, (a, b, c, d) in zip(range(blocks - 1, -1, -1), p.T[::-1].tolist(), strict=True):
        g0[k], g1[k] = x, 1 - x
        u, v = a * x + b * (1 - x), c * x + d * (1 - x)
        x = u / (u + v)
    before = np.empty((2, blocks, BLOCK))
    for k in range(BLOCK):
        before[0, :, k], before[1, :, k] = f0, f1
        u, v = f0 * m00[:, k] + f1 * m10[:, k], f0 * m01[:, k] + f1 * m11[:, k]
        f0, f1 = u / (u + v), v / (u + v)
    after = np.empty((2, blocks, BLOCK))
    for k in range(BLOCK - 1, -1, -1):
        after[0, :, k], after[1, :, k] = g0, g1
        u, v = m00[:, k] * g0 + m01[:, k] * g1, m10[:, k] * g0 + m11[:, k] * g1
        g0, g1 = u / (u + v), v / (u + v)
    b0, b1 = (x.reshape(-1)[:n] for x in before)
    a0, a1 = (x.reshape(-1)[:n] for x in after)
    x00, x01, x10, x11 = m[0, :n] * b0 * a0, m[1, :n] * b0 * a1, m[2, :n] * b1 * a0, m[3, :n] * b1 * a1
    z = x00 + x01 + x10 + x11
    toxic = (x01 + x11) / z
    stay = m[0, :n] * a0
    clean = np.log(stay / (stay + m[1, :n] * a1))
    inner = ~first
    moves = np.array([[(x00 / z)[inner].sum(), (x01 / z)[inner].sum()], [(x10 / z)[inner].sum(), (x11 / z)[inner].sum()]])
    starts = np.array([(1 - toxic)[first].sum(), toxic[first].sum()])
    return toxic, clean, moves, starts


def apart(docs: list[set[str]]) -> list[int]:
    """Numbers of the documents that are no near copies of earlier ones (copies would look like evidence)."""
    seen: dict[tuple[int, int], int] = {}
    keep = []
    for k, words in enumerate(docs):
        codes = np.fromiter((zlib.crc32(w.encode()) for w in words), np.uint64, len(words))
        mins = [(j, int(((codes * np.uint64(2 * j + 0x9E3779B1)) % np.uint64(4294967291)).min())) for j in range(6)]
        like = Counter(seen[m] for m in mins if m in seen).most_common(1)
        if not like or like[0][1] < 3:
            keep.append(k)
            for m in mins:
                seen.setdefault(m, k)
    return keep


def find_markers(docs: list[set[str]], toxic: list[bool], clean_weight: float, sure: float = 14.0, precise: float = 0.6) -> frozenset:
    """Words and beginnings that mark toxic documents.

    What counts is in how many different words of a document a feature occurs:
    a stem that a toxic document uses with many endings is evidence even if few
    such documents are known, a repeated line is not. A feature is a marker if
    its words in toxic documents exceed what its rate in clean ones lets
    expect by a log likelihood ratio of ``sure``, and if at least ``precise`` of all its
    words are in toxic documents; each clean row of the sample stands for
    ``clean_weight`` rows.
    """
    bad, good, n_bad, n_good = Counter(), Counter(), 0, 0.0
    for words, is_bad in zip(docs, toxic, strict=True):
        (bad if is_bad else good).update(f for w in words for f in beginnings(w))
        n_bad += len(words) if is_bad else 0
        n_good += 0.0 if is_bad else clean_weight * len(words)
    chosen = []
    for f, n in bad.items():
        clean = clean_weight * good[f]
        expected = n_bad * (clean + 0.5) / max(n_good, 1.0)
        if n > expected and n >= precise * (n + clean) and n * np.log(n / expected) - (n - expected) >= sure:
            chosen.append(f)
    return frozenset(chosen)


def _sample(docs, labels, id_col, text_col, label_id, label_col, max_toxic, max_clean):
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where(F.col("t").isNotNull() & ~held_out(F.col("i")))
    marks = labels.select(F.col(label_id).alias("i"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & ~held_out(F.col("i"))).groupBy("i").agg(F.max("y").alias("y"))
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = counts.get(1, 0), counts.get(0, 0)
    rate = F.when(F.col("y") == 1, min(1.0, max_toxic / max(bad, 1))).otherwise(min(1.0, max_clean / max(good, 1)))
    drawn = marks.where(F.pmod(F.xxhash64("i", F.lit(17)), F.lit(1_000_003)) < rate * 1_000_003)
    # `drawn` is bounded by max_toxic + max_clean rows, so it is sent to the texts and not the other way round;
    # one text of each id comes back, however often the id is repeated
    got = rows.join(F.broadcast(drawn), "i").groupBy("i").agg(F.max("y").alias("y"), F.min_by("t", F.xxhash64("t")).alias("t")).orderBy("i").toArrow()
    texts, y = got.column("t").to_pylist(), got.column("y").to_pylist()
    return texts, [v == 1 for v in y], max(1.0, good / max_clean)


def learn(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    label_col: str = "toxic",
    max_toxic: int = MAX_TOXIC,
    max_clean: int = MAX_CLEAN,
) -> Model:
    """Train on about ``max_toxic`` + ``max_clean`` labelled rows, none held out.

    The bound is on labelled ids, drawn by a hash; one text of each is read,
    whole. An id labelled twice counts as toxic if either label says so.
    """
    texts, toxic, weight = _sample(docs, labels, id_col, text_col, label_id, label_col, max_toxic, max_clean)
    one: dict[str, str] = {}  # each word once in memory
    tokens = [[one.setdefault(w, w) for w in map(str.lower, TOKEN.findall(t))] for t in texts]
    del texts
    full = [k for k, words in enumerate(tokens) if words]
    full = [full[k] for k in apart([set(tokens[k]) for k in full])]
    tokens, toxic = [tokens[k] for k in full], [toxic[k] for k in full]
    if not any(toxic):
        return Model()
    markers = find_markers([set(w) for w in tokens], toxic, weight)
    marked = {w: any(f in markers for f in beginnings(w)) for words in tokens for w in set(words)}
    number = {w: k for k, w in enumerate(marked)}
    feats = np.array([features(w) for w in number])
    word = np.fromiter((number[w] for words in tokens for w in words), np.int64)
    sizes = np.array([len(w) for w in tokens])
    first = np.zeros(len(word), bool)
    first[np.cumsum(sizes) - sizes] = True
    y = np.array(list(marked.values()))[word] & np.repeat(np.array(toxic), sizes)
    model = _train(word, feats, y, first)
    _fit_score(model, word, feats, first, sizes, np.array(toxic, float), weight)
    model.markers = markers
    return model


def _train(word, feats, y, first) -> Model:
    """Adam on the mean log likelihood of the labelled chains, with a small l2 penalty."""
    dims, n = 1 << FEATURE_BITS, len(word)
    seen = np.bincount(word, minlength=len(feats))
    gold = np.bincount(word, weights=y, minlength=len(feats))
    prev = np.roll(y, 1)
    inner = ~first
    gold_moves = np.array([[np.sum(~prev[inner] & ~y[inner]), np.sum(~prev[inner] & y[inner])], [np.sum(prev[inner] & ~y[inner]), np.sum(prev[inner] & y[inner])]])
    gold_starts = np.array([np.sum(~y[first]), np.sum(y[first])])
    scale = max(1.0, float(gold.sum()))
    model = Model(weights=np.zeros(dims))
    x = np.zeros(dims + 7)
    x[dims] = -4.0
    mean, square = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        emit = (x[:dims][feats].sum(1) + x[dims])[word]
        marginal, _, moves, starts = forward_backward(emit, first, x[dims + 1 : dims + 5].reshape(2, 2), x[dims + 5 :])
        diff = gold - np.bincount(word, weights=marginal, minlength=len(feats))
        grad = np.zeros_like(x)
        grad[:dims] = np.bincount(feats.ravel(), weights=np.repeat(diff, feats.shape[1]), minlength=dims) / scale - 1e-4 * x[:dims]
        grad[dims] = diff.sum() / scale
        grad[dims + 1 : dims + 5] = (gold_moves - moves).ravel() / scale
        grad[dims + 5 :] = (gold_starts - starts) / scale
        mean = 0.9 * mean + 0.1 * grad
        square = 0.98 * square + 0.02 * grad**2
        x += 0.25 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.98**step)) + 1e-6)
    assert seen.sum() == n
    model.weights, model.bias = x[:dims].astype(np.float32), float(x[dims])
    model.trans, model.start = x[dims + 1 : dims + 5].reshape(2, 2), x[dims + 5 :]
    return model


def _gather(toxic, clean, sizes, word):
    """Document measures: log of one plus the expected number of different toxic words, logit of any toxic token.

    ``word`` numbers each token's word; of a word repeated in a document the likeliest place counts.
    """
    many, none = np.zeros(len(sizes)), np.zeros(len(sizes))
    full = sizes > 0
    at = (np.cumsum(sizes) - sizes)[full]
    if len(toxic):
        none[full] = np.add.reduceat(clean, at)
        some = np.flatnonzero(toxic >= FAINT)
        doc = np.searchsorted(at, some, side="right") - 1
        order = np.lexsort((-toxic[some], word[some], doc))
        doc, kind, weight = doc[order], word[some][order], toxic[some][order]
        new = np.ones(len(order), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (kind[1:] != kind[:-1])
        many[full] = np.bincount(doc[new], weights=weight[new], minlength=len(at))
    some = -np.expm1(np.minimum(none, 0))
    return np.log1p(many), np.clip(np.log(np.maximum(some, 1e-9)) - none, -12, 12)


def _fit_score(model, word, feats, first, sizes, y, clean_weight):
    emit = (model.weights[feats].sum(1) + model.bias)[word]
    toxic, clean, _, _ = forward_backward(emit, first, model.trans, model.start)
    X = np.column_stack((np.ones(len(sizes)), *_gather(toxic, clean, sizes, word)))
    w = np.where(y > 0, 1.0, clean_weight)
    beta = np.array([-2.0, 1.0, 0.5])

    def loss(b):
        z = X @ b
        return float((w * (np.logaddexp(0, z) - y * z)).sum() + 0.05 * b @ b)

    for _ in range(50):  # Newton steps, halved until the penalised logistic likelihood improves
        p = 1 / (1 + np.exp(-np.clip(X @ beta, -30, 30)))
        grad = X.T @ (w * (y - p)) - 0.1 * beta
        hess = (X * (w * p * (1 - p))[:, None]).T @ X + 0.1 * np.eye(3)
        move = np.linalg.solve(hess, grad)
        while loss(beta + move) > loss(beta) and np.abs(move).max() > 1e-7:
            move = move / 2
        beta = beta + move
        if np.abs(move).max() < 1e-6:
            break
    beta[1:] = np.maximum(beta[1:], 0)  # more toxic tokens never lower a score
    model.logit = beta


class Scorer:
    """Scores batches with one model; keeps the weights of words between calls."""

    def __init__(self, model: Model):
        self.model, self.cache = model, {}

    def weigh(self, word: str) -> float:
        v = self.cache[word] = float(self.model.weights[features(word.lower())].sum() + self.model.bias)
        return v

    def __call__(self, texts: list[bytes], spans: bool = False, threshold: float = THRESHOLD):
        if len(self.cache) > CACHE_WORDS:
            self.cache = {}
        get, weigh = self.cache.get, self.weigh
        flat: list[str] = []
        decoded = [t.decode("utf-8", "replace") for t in texts]
        emit: list[float] = []
        sizes = np.zeros(len(texts), np.int64)
        for k, text in enumerate(decoded):
            words = TOKEN.findall(text)
            sizes[k] = len(words)
            flat += words
            for w in words:
                e = get(w)
                emit.append(weigh(w) if e is None else e)
        m = self.model
        if emit:
            first = np.zeros(len(emit), bool)
            first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
            toxic, clean, _, _ = forward_backward(np.array(emit), first, m.trans, m.start)
        else:
            toxic = clean = np.zeros(0)
        number = np.zeros(len(flat), np.int64)
        seen: dict[str, int] = {}
        for k in np.flatnonzero(toxic >= FAINT).tolist():
            number[k] = seen.setdefault(flat[k].lower(), len(seen))
        many, some = _gather(toxic, clean, sizes, number)
        score = 1 / (1 + np.exp(-np.clip(m.logit[0] + m.logit[1] * many + m.logit[2] * some, -30, 30)))
        found = [[] for _ in texts]
        if spans and len(toxic):
            at = np.cumsum(sizes) - sizes
            hot = (toxic >= 0.5) & np.repeat(score >= threshold, sizes)
            for k in np.unique(np.searchsorted(at, np.flatnonzero(hot), side="right") - 1):
                while sizes[k] == 0:
                    k -= 1
                mine = hot[at[k] : at[k] + sizes[k]]
                for j, t in enumerate(TOKEN.finditer(decoded[k])):
                    if mine[j]:
                        if found[k] and j and mine[j - 1]:
                            found[k][-1]["end"] = t.end()
                        else:
                            found[k].append({"start": t.start(), "end": t.end()})
        return score, found


SCHEMA = "held_out boolean, score double, predicted int, spans array<struct<start:int,end:int>>"


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and the toxic spans (code points, end exclusive) of every row."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in chunks(batches):
            score, spans = scorer(utf8(batch), spans=True, threshold=threshold)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32)), pa.array(spans, span)],
                names=["doc_id", "held_out", "score", "predicted", "spans"],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return as_binary(rows, "doc_id", "held_out").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
