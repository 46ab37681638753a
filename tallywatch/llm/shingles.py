"""Word shingles of whole texts as 64-bit hashes, by numpy over the bytes of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tallywatch.llm.common import mixed

_BASE = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes worked on at once; a longer text is worked on alone.
CHUNK = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the power of 0 to n, and of its inverse, modulo 2^64."""
    size = max(CHUNK, 1 << n.bit_length())
    if size not in _powers:
        found = []
        for base in (_BASE, _INVERSE):
            table = np.full(size + 1, base)
            table[0] = 1
            found.append(np.cumprod(table, dtype=np.uint64))
        if size > CHUNK:
            return tuple(found)
        _powers[size] = tuple(found)
    return _powers[size]


def chunked(offsets: np.ndarray, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts with `most` bytes together, or one longer text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last byte of each word."""
    word = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], word[:-1]]) & ~edge[:-1]
    after = np.concatenate([word[1:], [False]]) & ~edge[1:]
    return np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingles of each text, sorted, one text after the other; and n + 1 offsets into them.

    Words are lower-cased in A-Z and stand between ASCII white space; a text of fewer than k words has one
    shingle, all its words; one without words has none.
    """
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    data = LOWER[data]
    starts, ends = word_bounds(data, offsets)
    up, down = powers(len(data))
    total = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
    words = mixed((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)  # of each text's words
    many = np.diff(first)
    size = np.minimum(many, k)
    owner = np.repeat(np.arange(n), many - size + (size > 0))
    at = np.arange(len(owner)) - np.repeat(np.cumsum(many - size + (size > 0)) - (many - size + (size > 0)), many - size + (size > 0)) + first[owner]
    found = size[owner].astype(np.uint64)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    for j in range(k):
        found = mixed(found + np.where(j < size[owner], padded[at + j], np.uint64(0)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j))
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=n))])


def sets_of(texts: list[str], k: int) -> list[np.ndarray]:
    """The shingle set of each text, sorted."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw], dtype=np.int64)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    out: list[np.ndarray] = []
    for a, b in chunked(offsets):
        found, at = shingle_sets(data[offsets[a]: offsets[b]], offsets[a: b + 1] - offsets[a], k)
        out += [found[i:j] for i, j in zip(at[:-1], at[1:])]
    return out
