"""Numpy forms of the operators against plain loops."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tenure.llm import language, packing


def plain_two_fit(lengths, capacity):
    left, out = sorted(lengths), []
    while left:
        bin_ = [left.pop()]
        gap = capacity - bin_[0]
        while gap and any(x <= gap for x in left):
            x = max(x for x in left if x <= gap)
            left.remove(x)
            bin_.append(x)
            gap -= x
        if gap and left:
            small, room, best = min(bin_), gap + min(bin_), (0, 0, 0)
            for a in sorted({x for x in left if x <= room // 2}):
                others = left.copy()
                others.remove(a)
                b = max((x for x in left if x <= room - a), default=0)  # the longest beside it, if it is another piece
                if b >= a and b in others and a + b > best[0]:
                    best = (a + b, a, b)
            if best[0] > small:
                bin_.remove(small)
                left.remove(best[1])
                left.remove(best[2])
                bin_ += best[1:]
                left = sorted([*left, small])
        out.append(bin_)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_best_two_fit_equals_the_plain_form(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 50, 300])
    lengths = [rng.randint(1, capacity - 1) if seed % 3 else min(capacity - 1, 1 + int(rng.expovariate(4 / capacity))) for _ in range(rng.choice([1, 7, 200]))]
    got, want = packing.best_two_fit(np.array(lengths), capacity), plain_two_fit(lengths, capacity)
    assert [sorted(b) for b in got] == [sorted(b) for b in want]
    assert Counter(x for b in got for x in b) == Counter(lengths) and all(sum(b) <= capacity for b in got)


def plain_em(like, n, start, rounds):
    theta = list(start)
    for _ in range(rounds):
        new = [0.0] * len(theta)
        for row, count in zip(like, n, strict=True):
            part = [t * x for t, x in zip(theta, row, strict=True)]
            for k, p in enumerate(part):
                new[k] += count * p / max(sum(part), 1e-30)
        theta = [x / sum(n) for x in new]
    return theta, sum(count * np.log(max(sum(t * x for t, x in zip(theta, row, strict=True)), 1e-30)) for row, count in zip(like, n, strict=True))


def plain_mixture(like, n, languages):
    theta, _ = plain_em(like, n, [1 / languages] * languages, language.ROUNDS)
    order = sorted(range(languages), key=lambda k: -theta[k])
    best = sum(count * np.log(max(row[order[0]], 1e-30)) for row, count in zip(like, n, strict=True))
    out = [float(k == order[0]) for k in range(languages)]
    for k in range(2, languages + 1):
        inside = [theta[j] if j in order[:k] else 0.0 for j in range(languages)]
        fit, log = plain_em(like, n, [x / sum(inside) for x in inside], 8)
        log -= (k - 1) * 0.5 * np.log(max(sum(n), 2))
        if log > best:
            best, out = log, fit
    return out


def test_mixture_equals_plain_expectation_maximisation():
    rng = np.random.default_rng(9)
    languages, sizes, like, n = 4, [], [], []
    for d in range(60):  # one language, two or three in clear shares, and few words
        words = int(rng.choice([1, 2, 12, 60]))
        mine = rng.choice(languages, int(rng.choice([1, 2, 3])), replace=False)
        for _ in range(words):
            row = rng.random(languages) * 0.02 + 1e-4
            row[rng.choice(mine)] += rng.random()
            like.append(row)
            n.append(float(rng.integers(1, 4)))
        sizes.append(words)
    like, n, sizes = np.array(like, np.float32), np.array(n, np.float32), np.array(sizes)
    got = language.mixture(like, n, sizes, languages)
    at = np.cumsum(sizes) - sizes
    for d, (a, size) in enumerate(zip(at, sizes, strict=True)):
        want = np.array(plain_mixture(like[a : a + size].tolist(), n[a : a + size].tolist(), languages))
        assert np.allclose(got[d], want, atol=0.02), d  # rounds stop early where all documents have settled
        assert ((got[d] > 0) == (want > 0)).all() and got[d].argmax() == want.argmax()
