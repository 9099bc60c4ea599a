"""Words of many texts as 64-bit hashes, with numpy; runs inside tasks.

A text is bytes (UTF-8).  A-Z are lower-cased, words are what stands between the
bytes 20 and 09-0D.  Texts are worked on in pieces of half a MB, so memory does
not grow with a batch; a longer text is cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 19
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = 0x9E3779B97F4A7C15  # any odd number: powers of it have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        made = []
        for base in (_BASE, _INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            made.append(np.cumprod(p, dtype=np.uint64))
        _powers = (made[0], made[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def salt(n: int) -> np.uint64:
    """A 64-bit constant for a small number."""
    return mix(np.array([n * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 & (1 << 64) - 1], np.uint64))[0]


def _piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word."""
    b = np.frombuffer(data, np.uint8)
    edge = np.diff((~_SPACE[b]).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _power_tables(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def _cut(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > PIECE:
        end = at + PIECE
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_hashes(texts: list[bytes | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of consecutive texts as (index of the first, where each text's words begin and end, hashes of all words).

    Bounds have one number more than the group has texts.
    """
    i = 0
    while i < len(texts):
        j, total = i, 0
        while j < len(texts) and (j == i or total + len(texts[j] or b"") <= PIECE):
            total += len(texts[j] or b"") + 1
            j += 1
        group = [(t or b"").lower() for t in texts[i:j]]
        if j == i + 1 and len(group[0]) > PIECE:
            h = np.concatenate([_piece(p)[1] for p in _cut(group[0])])
            yield i, np.array([0, len(h)]), h
        else:
            begin = np.cumsum([0] + [len(t) + 1 for t in group])
            starts, h = _piece(b"\n".join(group))
            yield i, np.searchsorted(starts, begin), h
        i = j


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of every k-word shingle; a text of fewer words, but one at least, has its whole sequence as one."""
    n = len(words)
    of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    out_of, out_h = [], []
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for p in range(k):
            h += mix(words[p : n - k + 1 + p] + salt(p))
        whole = of[: n - k + 1] == of[k - 1 :]
        out_of.append(of[: n - k + 1][whole])
        out_h.append(mix(h[whole]))
    size = np.diff(bounds)
    for t in np.flatnonzero((size > 0) & (size < k)):
        w = words[bounds[t] : bounds[t + 1]]
        h = np.zeros(1, np.uint64) + salt(100 + len(w))
        for p in range(len(w)):
            h += mix(w[p : p + 1] + salt(p))
        out_of.append(np.array([t]))
        out_h.append(mix(h))
    if not out_of:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(out_of), np.concatenate(out_h)


def shingle_sets(texts: list[bytes | None], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """As ``word_hashes``, for the distinct shingles of each text in ascending order."""
    for first, bounds, words in word_hashes(texts):
        of, h = shingles(words, bounds, k)
        order = np.lexsort((h, of))
        of, h = of[order], h[order]
        if len(h):
            new = np.ones(len(h), bool)
            new[1:] = (of[1:] != of[:-1]) | (h[1:] != h[:-1])
            of, h = of[new], h[new]
        yield first, np.searchsorted(of, np.arange(len(bounds))), h
