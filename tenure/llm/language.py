"""Language of documents as a mixture, by expectation-maximisation.

Each learned language is a distribution over character trigrams of lower-cased
words. A document is a mixture: EM over its words (in texts of LONG_WORDS words
or more over runs of UNIT_WORDS words, to which single words add little) estimates
how large a share each language has. The set of languages is chosen by penalised likelihood: the
languages are ordered by share, nested sets are fitted again, and a further
language must pay half a log of the word count. The largest share names the
document.

The model is fitted on a sample of labelled rows (``max_rows`` of them, or
MIN_ROWS for each language if that is more) and knows every language that has a
row to learn from. It holds the counted ones of 2 ** GRAM_BITS hashed trigrams; scoring is a map over all documents
with whole texts, in numpy over many texts at once, no shuffle.

Defined results: null text, empty text and text without a letter give ``und``
with score 0; rows with null lang teach nothing; with no labelled rows every
document is ``und``; ids may be of any type; repeated rows get one row each;
other columns are unread. ``keep_known`` rejects only what is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_binary, chunks, free_name, held_out, utf8

MAX_ROWS = 6000
#: Labelled rows drawn of each language however many languages there are.
MIN_ROWS = 20
#: Models of more languages are summed over the trigrams they hold, not looked up in a full table.
TABLE_LANGUAGES = 200
#: Words (or runs) times languages that are held at once, unless one text alone has more.
CELLS = 8 << 20
#: Code points of text whose trigrams are computed at once.
WINDOW = 1 << 18
#: Log probabilities (trigrams times languages) that are looked up at once, unless one unit alone has more.
LOOKED_UP = 1 << 20
GRAM_BITS = 16
#: Texts of LONG_WORDS words or more are mixtures of runs of UNIT_WORDS words, shorter ones of words.
LONG_WORDS = 32
UNIT_WORDS = 4
OVERLAP = 1.5
ROUNDS = 12


@dataclass
class Model:
    """Log probabilities of hashed trigrams: ``base`` of each language, plus ``more`` for those that it has."""

    languages: list[str]
    base: np.ndarray
    first: np.ndarray  # (2 ** GRAM_BITS + 1): where each trigram's entries begin
    lang: np.ndarray
    more: np.ndarray

    def table(self) -> np.ndarray:
        """(2 ** GRAM_BITS, languages)"""
        full = np.tile(self.base, (1 << GRAM_BITS, 1))
        full[np.repeat(np.arange(1 << GRAM_BITS), np.diff(self.first)), self.lang] += self.more
        return full.astype(np.float32)

    def summed(self, gram: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Sums over the runs of ``gram`` that begin at ``cut``, by language."""
        size = np.diff(np.append(cut, len(gram)))
        out = size[:, None] * self.base
        begin, n = self.first[gram], self.first[gram + 1] - self.first[gram]
        run = np.repeat(np.arange(len(cut)), size)
        step = np.searchsorted(np.cumsum(n), np.arange(0, n.sum() + CELLS, CELLS))
        for a, b in zip(step, [*step[1:], len(gram)], strict=True):
            k = n[a:b]
            if k.sum():
                at = np.repeat(begin[a:b] - np.cumsum(k) + k, k) + np.arange(k.sum())
                low, high = run[a], run[b - 1] + 1
                cell = (np.repeat(run[a:b], k) - low) * len(self.languages) + self.lang[at]
                out[low:high] += np.bincount(cell, weights=self.more[at], minlength=(high - low) * len(self.languages)).reshape(high - low, -1)
        return out.astype(np.float32)


def model_of(names: pa.Array, gram: np.ndarray, n: np.ndarray) -> Model:
    """The model of the counts ``n`` of ``gram`` in the languages ``names``, one entry for each pair."""
    coded = names.dictionary_encode()
    found = coded.dictionary.to_pylist()
    languages = sorted(found)
    number = {x: k for k, x in enumerate(languages)}
    lang = np.array([number[x] for x in found], np.int32)[coded.indices.to_numpy()]
    order = np.argsort(gram, kind="stable")
    gram, lang, n = gram[order], lang[order], n[order]
    total = np.bincount(lang, weights=n, minlength=len(languages)) + 0.02 * (1 << GRAM_BITS)
    first = np.concatenate([[0], np.cumsum(np.bincount(gram, minlength=1 << GRAM_BITS))]).astype(np.int64)
    return Model(languages, np.log(0.02 / total), first, lang, np.log((n + 0.02) / 0.02))


_LOWER: list[np.ndarray] = []


def _lower_letters() -> np.ndarray:
    """Code point -> lower-case letter, 0 if no letter; made once in each process."""
    if not _LOWER:
        points = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            if (ch := chr(c)).isalpha():
                points[c] = ord(ch.lower()[0])
        _LOWER.append(points)
    return _LOWER[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of all words of the texts, the trigram at which each word begins, and each word's text.

    A word is a run of letters; its trigrams run over the lower-cased letters
    with two blanks before and one behind. Besides the result, only WINDOW code
    points are laid out at once, however long the texts are.
    """
    joined = "\0\0" + "\0".join(texts) + "\0"
    grams, starts, places, before = [], [], [], 0
    for a in range(0, len(joined) - 2, WINDOW):
        flat = np.frombuffer(joined[a : a + WINDOW + 2].encode("utf-32-le", "replace"), np.uint32)
        c = _lower_letters()[np.minimum(flat, 0x10FFFF)]
        here, one, two = c[2:], c[1:-1], c[:-2]
        use = np.flatnonzero((here != 0) | (one != 0))
        here, one = here[use], one[use]
        two = np.where(one == 0, 0, two[use])
        gram = two * np.uint32(0x9E3779B1) ^ one * np.uint32(0x85EBCA77) ^ here * np.uint32(0xC2B2AE3D)
        gram = (gram ^ (gram >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        grams.append((gram >> np.uint32(32 - GRAM_BITS)).astype(np.int32))
        begin = np.flatnonzero(one == 0)
        starts.append(begin + before)
        places.append(use[begin] + a)
        before += len(use)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    text = np.searchsorted(ends, np.concatenate(places), side="right")
    return np.concatenate(grams), np.concatenate(starts), text


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> Model:
    """Fit on about ``max_rows`` labelled rows, shared evenly between the languages, but at least about MIN_ROWS of each.

    The rows are drawn by a hash of their id at a rate from exact counts, so the
    sample is the same in every run and its size does not grow with the table.
    The rows of the lowest hash of a language are always drawn, so none is lost.
    Rows held out (crc32 of the id mod 4 is 2) are never used.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").cast("string").alias("l"))
    rows = rows.where(F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("i")))
    # hashing the length as well spreads rows that repeat one id
    rows = rows.withColumn("h", F.pmod(F.xxhash64("i", F.length("t"), F.lit(91)), F.lit(1_000_003)))
    counts = rows.groupBy("l").agg(F.count(F.lit(1)).alias("rows"), F.min("h").alias("least")).toArrow()
    share = max(MIN_ROWS, max_rows // max(counts.num_rows, 1))
    bound = [max(low + 1.0, min(1.0, share / n) * 1_000_003) for n, low in zip(counts.column("rows").to_pylist(), counts.column("least").to_pylist(), strict=True)]
    bounds = docs.sparkSession.createDataFrame(pa.table({"l": counts.column("l").cast(pa.string()), "bound": pa.array(bound, pa.float64())}))
    drawn = rows.join(F.broadcast(bounds), "l").where("h < bound")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = np.bincount(trigrams([text])[0], minlength=1 << GRAM_BITS)
                seen[lang] = seen[lang] + found if lang in seen else found
        for lang, found in seen.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(found[at].astype(np.int64))], names=["l", "gram", "n"])

    # the driver gets at most 2 ** GRAM_BITS counts a language, never the texts
    summed = drawn.select("l", "t").mapInArrow(count, "l string, gram int, n bigint").groupBy("l", "gram").agg(F.sum("n").alias("n")).toArrow()
    return model_of(summed.column("l").cast(pa.string()).combine_chunks(), summed.column("gram").to_numpy(), summed.column("n").to_numpy())


def _slices(group: np.ndarray) -> list[tuple[int, int]]:
    """Neighbours of one group together."""
    cuts = (np.flatnonzero(np.diff(group)) + 1).tolist()
    return list(zip([0, *cuts], [*cuts, len(group)], strict=True))


class Scorer:
    """Scores lists of texts with one model."""

    def __init__(self, model: Model):
        self.model = model
        self.weights = model.table() if len(model.languages) <= TABLE_LANGUAGES else None

    def _looked_up(self, gram: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """As ``Model.summed``, from the full table, some units at a time."""
        out = np.empty((len(cut), len(self.model.languages)), np.float32)
        for a, b in _slices(cut * len(self.model.languages) // LOOKED_UP):
            stop = cut[b] if b < len(cut) else len(gram)
            out[a:b] = np.add.reduceat(self.weights[gram[cut[a] : stop]], cut[a:b] - cut[a], axis=0)
        return out

    def __call__(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        langs = self.model.languages
        pred, score = ["und"] * len(texts), np.zeros(len(texts))
        if not langs:
            return pred, score
        gram, starts, doc = trigrams([t.decode("utf-8", "replace") for t in texts])
        if not len(starts):
            return pred, score
        words = np.bincount(doc, minlength=len(texts))
        first_word = np.cumsum(words) - words
        place = np.arange(len(doc)) - first_word[doc]
        unit_words = np.where(words < LONG_WORDS, 1, UNIT_WORDS)[doc]
        begins = place % unit_words == 0
        cut = np.flatnonzero(begins)
        units = np.bincount(doc[cut], minlength=len(texts))
        group = np.cumsum(units) * len(langs) // CELLS
        if group[-1] > group[0] and len(texts) > 1:
            parts = [self(texts[a:b]) for a, b in _slices(group)]
            return [p for part in parts for p in part[0]], np.concatenate([part[1] for part in parts])
        logs = self.model.summed(gram, starts[cut]) if self.weights is None else self._looked_up(gram, starts[cut])
        # the trigrams of a unit overlap, so their product is too sure of itself by about this much
        logs = (logs - logs.max(1, keepdims=True)) / OVERLAP
        like = np.exp(np.maximum(logs, -60))
        n = np.diff(np.append(cut, len(doc))).astype(np.float32)
        which = np.flatnonzero(units)
        shares = mixture(like, n, units[which], len(langs))
        top = shares.argmax(1)
        for j, k in enumerate(which.tolist()):
            pred[k] = langs[top[j]]
        score[which] = (shares.max(1) * words[which] + 1 / len(langs)) / (words[which] + 1)
        return pred, score


def _em(like, n, sizes, start, rounds):
    """Shares of each document's languages after EM, and the log likelihood."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    total = np.add.reduceat(n, first)[:, None]
    theta = start.astype(np.float32)
    for _ in range(rounds):
        part = theta[doc] * like
        part *= (n / np.maximum(part.sum(1), 1e-30))[:, None]
        new = np.add.reduceat(part, first) / total
        moved = np.abs(new - theta).max()
        theta = new
        if moved < 1e-3:
            break
    mix = np.log(np.maximum((theta[doc] * like).sum(1), 1e-30)) * n
    return theta, np.add.reduceat(mix, first)


def mixture(like: np.ndarray, n: np.ndarray, sizes: np.ndarray, languages: int) -> np.ndarray:
    """Shares (documents x languages), zero outside the chosen set."""
    docs = len(sizes)
    start = np.full((docs, languages), 1 / languages, np.float32)
    theta, _ = _em(like, n, sizes, start, ROUNDS)
    first = np.cumsum(sizes) - sizes
    words = np.add.reduceat(n, first)
    order = np.argsort(-theta, axis=1, kind="stable")
    top = order[:, 0]
    logs = np.log(np.maximum(like[np.arange(len(like)), np.repeat(top, sizes)], 1e-30)) * n
    best = np.add.reduceat(logs, first)
    out = np.zeros_like(theta)
    out[np.arange(docs), top] = 1
    open_ = np.flatnonzero(theta.max(1) < 0.9995) if languages > 1 else np.zeros(0, int)
    for k in range(2, languages + 1):
        open_ = open_[theta[open_, order[open_, k - 1]] > 1e-4] if len(open_) else open_
        if not len(open_):
            break
        take = np.isin(np.repeat(np.arange(docs), sizes), open_)
        inside = np.zeros((len(open_), languages), np.float32)
        rows = np.arange(len(open_))[:, None]
        inside[rows, order[open_, :k]] = theta[open_][rows, order[open_, :k]]
        inside /= inside.sum(1, keepdims=True)
        fit, log = _em(like[take], n[take], sizes[open_], inside, 8)
        log = log - (k - 1) * 0.5 * np.log(np.maximum(words[open_], 2))
        better = log > best[open_]
        best[open_[better]] = log[better]
        out[open_[better]] = fit[better]
    return out


SCHEMA = "held_out boolean, lang_pred string, score double"


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in chunks(batches):
            pred, score = scorer(utf8(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return as_binary(rows, "doc_id", "held_out").mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")


def known(model: Model, text: Column) -> Column:
    """True where the method names a language (not ``und``), however many share the document."""

    @F.arrow_udf("boolean")
    def check(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model)
        for texts in batches:
            rows = pa.RecordBatch.from_arrays([texts], names=["text"])
            keep: list[bool] = []
            for part in chunks([rows]):
                pred, _ = scorer(utf8(part))
                keep += [p != "und" for p in pred]
            yield pa.array(keep, pa.bool_())

    return check(text.cast("string").cast("binary"))


def keep_known(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents whose language is found, with their columns unchanged."""
    flag = free_name(docs, "known_language")
    return docs.withColumn(flag, known(model, F.col(f"`{text_col}`"))).where(F.col(flag)).drop(flag)
