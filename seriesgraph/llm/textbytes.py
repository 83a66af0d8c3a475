"""Words of many texts at once, on bytes: boundaries, hashes and shingles in numpy."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))
_INVERSES = np.ones(1, np.uint64)

#: ASCII white space, as the contract of the n-gram join has it: blank and 0x09 to 0x0D.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])


def table(separators: bytes) -> np.ndarray:
    """True for the bytes of words."""
    t = np.ones(256, bool)
    t[np.frombuffer(separators, np.uint8)] = False
    return t


NOT_BLANK = table(BLANKS)
#: Letters and digits; all bytes from 0x80 count as letters.
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS), 1 << 16)
        _POWERS = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _ODD))), dtype=np.uint64)
        _INVERSES = np.cumprod(np.concatenate(([np.uint64(1)], np.full(size - 1, _INVERSE))), dtype=np.uint64)
    return _POWERS, _INVERSES


def join_texts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts with a blank after each, start of each text and the end)."""
    parts = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=offsets[1:])
    return np.frombuffer(b" ".join([*parts, b""]), np.uint8), offsets


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each text and the count) of the maximal runs of inside bytes."""
    edge = np.diff(inside[data].view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of each word, by differences of a running polynomial, block by block."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        at = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, at + block, side="right")))
        piece = data[at : ends[hi - 1]].astype(np.uint64) + np.uint64(1)
        powers, inverses = _powers(len(piece) + 1)
        run = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(mix(piece) * powers[: len(piece)], out=run[1:])
        s, e = starts[lo:hi] - at, ends[lo:hi] - at
        out[lo:hi] = mix((run[e] - run[s]) * inverses[s] + (e - s).astype(np.uint64))
        lo = hi
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of width words within a text, first shingle of each text and the count).

    A text with fewer words has its whole sequence as one; a text without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    begin = np.zeros(len(n) + 1, np.int64)
    np.cumsum(count, out=begin[1:])
    weights = mix(np.arange(1, width + 1, dtype=np.uint64) * _ODD) | np.uint64(1)
    at = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    length = np.repeat(np.minimum(n, width), count)
    total = np.zeros(len(at), np.uint64)
    for k in range(width):
        use = length > k
        if use.all():
            total += hashes[at + k] * weights[k]
        else:
            total[use] += hashes[at[use] + k] * weights[k]
    return mix(total + length.astype(np.uint64) * _ODD), begin


def sets(texts: list[str | None], width: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (words: runs without white space, A-Z as a-z)."""
    data, offsets = join_texts(texts)
    data = LOWER[data]
    starts, ends, first = words(data, offsets, NOT_BLANK)
    h, begin = shingles(word_hashes(data, starts, ends), first, width)
    return [_distinct(h[begin[i] : begin[i + 1]]) for i in range(len(texts))]


def _distinct(h: np.ndarray) -> np.ndarray:
    if len(h) < 2:
        return h.copy()
    h = np.sort(h)
    keep = np.empty(len(h), bool)
    keep[0] = True
    np.not_equal(h[1:], h[:-1], out=keep[1:])
    return h[keep]


def batches(texts: list[str | None], limit: int = 1_000_000):
    """Index ranges of texts with about limit characters each; a longer text has a range of its own."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > limit:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


#: Translations of bytes: A-Z as a-z, white space as a blank; of terms, all but letters and bytes from 0x80 as blanks.
FOLD_WORDS = bytes(32 if b in BLANKS else LOWER[b] for b in range(256))
FOLD_TERMS = bytes(LOWER[b] if b >= 0x80 or chr(b).isalpha() else 32 for b in range(256))


def split_words(text: str | None, fold: bytes, size: int = 1 << 20):
    """The words of a text as lists of bytes, about size bytes of text at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(fold)
    lo = 0
    while lo < len(data):
        hi = data.find(b" ", lo + size)
        hi = len(data) if hi < 0 else hi
        yield data[lo:hi].split()
        lo = hi
