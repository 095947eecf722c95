"""Repetition coverage of single documents (quality rules).

Words become numbers; polynomial rolling hashes of several n-gram lengths are
computed in numpy over many documents at once. A window that occurred earlier
in the same document marks its words, and the characters of marked words
measure how much of the document repeats itself. A window of n+1 words can
only repeat where its first n words do, so each length looks only at windows
that already repeated one length below. Lines are compared as they stand.

Every document is judged alone, in a map over the input: no shuffle.

Defined results: null and empty texts have no words and fail the base rule;
ties and repeated rows get one row each; other columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Numbered, as_binary, chunks, utf8

# N-gram length -> largest share of word characters that may lie
# in windows seen before, and the same for whole lines seen before.
# One repeated sentence in a short text stays below them.
NGRAM_LIMITS = {5: 0.30, 6: 0.28, 7: 0.26, 8: 0.24, 9: 0.22, 10: 0.20}
LINE_LIMIT = 0.30
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)

SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, dup_line_share double, worst_ngram int, worst_ngram_share double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _groups(keys: np.ndarray, same) -> tuple[np.ndarray, np.ndarray]:
    """For windows in order of place: flags (has a twin, has an earlier twin), by equal key.

    A count of 20 key bits finds the few windows that can have a twin at all;
    only these are sorted. ``same`` confirms neighbours in the sort word by word.
    """
    twin, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    cell = (keys >> np.uint64(44)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(cell, minlength=1)[cell] > 1)
    if not len(maybe):
        return twin, later
    maybe = maybe[np.argsort(keys[maybe], kind="stable")]
    eq = keys[maybe][1:] == keys[maybe][:-1]
    hit = np.flatnonzero(eq)
    eq[hit] = same(maybe[hit], maybe[hit + 1])
    twin[maybe[1:][eq]] = twin[maybe[:-1][eq]] = True
    later[maybe[1:][eq]] = True
    return twin, later


def _cover(n_words: int, starts: np.ndarray, n: int) -> np.ndarray:
    """Words inside the windows of n words that begin at ``starts``."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + n, -1)
    return np.cumsum(step[:-1]) > 0


def measure(texts: list[bytes], limits: dict[int, float] = NGRAM_LIMITS) -> dict[str, np.ndarray]:
    """Counts and shares of each text; the base columns are exact."""
    number, decoded = Numbered(), [t.decode("utf-8", "replace") for t in texts]
    split = [t.split() for t in texts]
    docs = len(texts)
    n_words = np.array([len(w) for w in split], np.int64)
    total = int(n_words.sum())
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, total)
    chars_of = np.array([len(w.decode("utf-8", "replace")) for w in number], np.int64)
    chars = chars_of[ids] if total else np.zeros(0, np.int64)
    doc = np.repeat(np.arange(docs), n_words)
    end = np.cumsum(n_words)
    place = np.arange(total)

    def by_doc(values):
        return np.bincount(doc, weights=values, minlength=docs).astype(np.int64) if total else np.zeros(docs, np.int64)

    out = {"n_words": n_words, "word_chars": by_doc(chars)}
    out["n_symbols"] = np.array([sum(t.count(s) for s in _SYMBOLS) for t in texts], np.int64)
    dup_lines, dup_chars = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    for k, t in enumerate(decoded):
        seen: set[str] = set()
        for line in t.split("\n"):
            if line in seen:
                if words := line.encode().split():
                    dup_lines[k] += 1
                    dup_chars[k] += sum(len(w.decode()) for w in words)
            else:
                seen.add(line)
    out["n_dup_lines"] = dup_lines

    code = _mix(np.arange(1, len(number) + 1, dtype=np.uint64) * _BASE)[ids] if total else np.zeros(0, np.uint64)
    salt = _mix(doc.astype(np.uint64) + np.uint64(0x51ED27))

    def rolled(starts, n):
        h = np.zeros(len(starts), np.uint64)
        for k in range(n):
            h = h * _BASE + code[starts + k]
        return _mix(h ^ salt[starts])

    def same(starts, n):
        def test(a, b):
            a, b = starts[a], starts[b]
            ok = doc[a] == doc[b]
            for k in range(n):
                ok &= ids[a + k] == ids[b + k]
            return ok

        return test

    starts = place[place + 3 <= end[doc]] if total else place
    twin, _ = _groups(rolled(starts, 3), same(starts, 3))
    repeated = _cover(total, starts[twin], 3)
    out["n_repeat_words"] = by_doc(repeated)
    starts = starts[twin]
    worst, worst_n = np.zeros(docs), np.zeros(docs, np.int32)
    bad = np.zeros(docs, bool)
    word_chars = np.maximum(out["word_chars"], 1)
    for n in sorted(limits):
        starts = starts[starts + n <= end[doc[starts]]]
        twin, later = _groups(rolled(starts, n), same(starts, n))
        share = by_doc(chars * _cover(total, starts[later], n)) / word_chars
        bad |= share > limits[n]
        over = share > worst
        worst[over], worst_n[over] = share[over], n
        starts = starts[twin]
    out["dup_line_share"] = dup_chars / word_chars
    out["worst_ngram"], out["worst_ngram_share"] = worst_n, worst
    out["base_failed"] = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * n_words)
    out["kept"] = ~(out["base_failed"] | bad | (out["dup_line_share"] > LINE_LIMIT))
    return out


def repetition_coverage(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base counts, base verdict, the method's verdict and its measures."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in chunks(batches):
            got = measure(utf8(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(got[c]) for c in names)], names=["doc_id", *names])

    return as_binary(docs, id_col, text=text_col).mapInArrow(score, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {SCHEMA}")
