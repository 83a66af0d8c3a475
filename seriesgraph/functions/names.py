"""Similarity of names: the weighted ratio and Jaro-Winkler, and indices that score only pairs whose bound allows it.

A common subsequence has no more letters than two names have in common, whatever their order; nor has any order of
their words. Counts of letters and lengths so bound every branch of both measures from above, and a search that goes
down these bounds and stops below what it has found gives the same as one that scores every pair.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, on bits of an integer."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 2 * common_length(a, b) / (len(a) + len(b)) if a or b else 1.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter with a window of the longer, windows over its ends included."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    n = len(short)
    return max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = (" ".join(sorted(s)) for s in (x & y, x - y, y - x))
    if both and (not only_x or not only_y):
        return 1.0
    first, second = (f"{both} {only}".strip() for only in (only_x, only_y))
    scores = [ratio(first, second)]
    if both:
        scores += [ratio(both, first), ratio(both, second)]
    return max(scores)


def partial_token_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if x & y:
        return 1.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(x)), " ".join(sorted(y))))


@lru_cache(maxsize=100_000)
def weighted_ratio(a: str, b: str) -> float:
    """0 to 1, of names that are normalised already; by the quotient of their lengths whole or partial comparisons."""
    if not a or not b:
        return 0.0
    whole, quotient = ratio(a, b), max(len(a), len(b)) / min(len(a), len(b))
    if quotient < 1.5:
        return max(whole, 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    scale = 0.6 if quotient > 8 else 0.9
    return max(whole, scale * partial_ratio(a, b), 0.95 * scale * partial_token_ratio(a, b))


def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used = [False] * len(b)
    left = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, u in zip(b, used) if u]
    m = len(left)
    swaps = sum(x != y for x, y in zip(left, right)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * weight * (1 - jaro) if jaro > 0.7 else jaro


LETTERS = 40
_PLACE = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789 ")}


def _letters(name: str) -> dict[int, int]:
    """How often a name has each letter; all beyond a-z, 0-9 and the blank share three places, which only raises bounds."""
    out: dict[int, int] = defaultdict(int)
    for c in name:
        out[_PLACE[c] if c in _PLACE else 37 + ord(c) % 3] += 1
    return out


class Bags:
    """Names in order of arrival, with what bounds their likeness to another name."""

    def __init__(self):
        self.names: list[str] = []
        self.counts = np.zeros((LETTERS, 64), np.uint16)
        self.length = np.zeros(64, np.int64)

    def add(self, name: str) -> int:
        n = len(self.names)
        if n == len(self.length):
            self.counts = np.concatenate((self.counts, np.zeros_like(self.counts)), axis=1)
            self.length = np.concatenate((self.length, np.zeros_like(self.length)))
        for place, k in _letters(name).items():
            self.counts[place, n] = min(k, 65_535)
        self.length[n] = len(name)
        self.names.append(name)
        return n

    def common(self, name: str) -> np.ndarray:
        """Letters that each name has in common with this one, at most."""
        out = np.zeros(len(self.names), np.int64)
        for place, k in _letters(name).items():
            out += np.minimum(self.counts[place, : len(self.names)], min(k, 65_535))
        return out


class NameIndex(Bags):
    """Names of one kind, each of an owner, for the best owners of a query by weighted ratio."""

    def __init__(self):
        super().__init__()
        self.owners: list[str] = []
        self.labels: list[str] = []
        self.unique = np.zeros(64, np.int64)
        self.words: dict[str, list[int]] = defaultdict(list)
        self.scored = 0

    def put(self, name: str, owner: str, label: str) -> None:
        """name is normalised; label is what it came from."""
        n = self.add(name)
        if n == len(self.unique):
            self.unique = np.concatenate((self.unique, np.zeros_like(self.unique)))
        words = set(name.split())
        self.unique[n] = len(" ".join(words))
        for w in words:
            self.words[w].append(n)
        self.owners.append(owner)
        self.labels.append(label)

    def bounds(self, name: str) -> np.ndarray:
        """An upper bound of the weighted ratio of the query with every name, branch by branch."""
        n = len(self.names)
        m, length, unique = self.common(name), self.length[:n], self.unique[:n]
        words = set(name.split())
        own, own_unique = len(name), len(" ".join(words))
        both = np.full(n, -1, np.int64)  # the length of the words in common, joined
        for w in words:
            if w in self.words:
                both[self.words[w]] += len(w) + 1
        shorter = np.minimum(unique, own_unique)
        lengths = np.maximum(unique + own_unique, 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            quotient = np.maximum(length, own) / np.minimum(length, own)
            whole = np.minimum(2 * m / lengths, 1.0)
            sets = np.where(both < 0, whole, np.where(both >= shorter, 1.0, np.maximum(whole, 2 * both / (both + shorter))))
            part = np.minimum(m, shorter)
            part = np.where(shorter > 0, 2 * part / (shorter + part), 1.0)  # of blanks alone
        scale = np.where(quotient > 8, 0.6, 0.9)
        near = np.maximum(np.minimum(2 * m / np.maximum(length + own, 1), 1.0), 0.95 * np.maximum(whole, sets))
        far = np.maximum(np.minimum(2 * m / np.maximum(length + own, 1), 1.0), np.maximum(scale * part, 0.95 * scale * np.where(both >= 0, 1.0, part)))
        out = np.where(quotient < 1.5, near, far)
        out[(length == 0) | (own == 0)] = 0.0
        return out + 1e-9

    def best(self, name: str, floor: float, k: int = 1) -> list[tuple[float, str, str]]:
        """(score, owner, label) of the k owners of the best scores from floor on; ties go to the lesser owner, then label."""
        if not self.names:
            return []
        bound = self.bounds(name)
        rows = np.flatnonzero(bound >= floor)
        rows = rows[np.argsort(-bound[rows], kind="stable")]
        found: dict[str, tuple[float, str, str]] = {}
        bar, last = floor, None  # the k-th score so far, and its owner
        for i in rows.tolist():
            owner = self.owners[i]
            if bound[i] < bar:
                break
            had = found.get(owner)
            if had is not None and bound[i] < had[0]:
                continue
            if k == 1 and had is not None and bound[i] <= had[0] + 2e-9:
                continue  # no more than its owner has
            self.scored += 1
            score = weighted_ratio(name, self.names[i])
            if score >= floor and (had is None or (-score, self.labels[i]) < (-had[0], had[2])):
                found[owner] = (score, owner, self.labels[i])
                if len(found) >= k:
                    kth = sorted(found.values(), key=lambda f: (-f[0], f[1]))[k - 1]
                    bar, last = max(floor, kth[0]), kth[1]
        return sorted(found.values(), key=lambda f: (-f[0], f[1], f[2]))[:k]


class WinklerIndex(Bags):
    """Names for all pairs whose Jaro-Winkler likeness reaches a floor."""

    scored = 0

    def near(self, name: str, floor: float) -> list[tuple[int, float]]:
        m, length, own = self.common(name), self.length[: len(self.names)], len(name)
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = np.where(m > 0, (m / length + m / max(own, 1) + 1) / 3, 0.0)
        bound = np.minimum(jaro + 0.4 * (1 - jaro), 1.0) + 1e-9
        bound[(length == 0) & (own == 0)] = 1.0
        out = []
        for i in np.flatnonzero(bound >= floor).tolist():
            self.scored += 1
            score = jaro_winkler(name, self.names[i])
            if score >= floor:
                out.append((i, score))
        return out


def _vectorised(function):
    def score(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in pairs:
            yield pd.Series([None if x is None or y is None else function(x, y) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(score, "double")


def weighted_ratio_of(a, b):
    """Column: weighted ratio of two normalised names; distinct pairs should be scored once."""
    return _vectorised(weighted_ratio)(a, b)


def jaro_winkler_of(a, b):
    return _vectorised(jaro_winkler)(a, b)
