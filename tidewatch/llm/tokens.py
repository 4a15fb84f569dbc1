"""Hashes of all words of many texts at once, for use inside tasks.

A word's hash is a polynomial of its bytes modulo 2^64 with a random value
per byte, read off running sums, then mixed. Texts are worked on in blocks of
about a megabyte, so a batch needs little memory besides its result.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 20
SPACES = b" \t\n\x0b\x0c\r"

_made: dict = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _tables(n: int):
    if "byte" not in _made:
        byte = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        byte[ord("A") : ord("Z") + 1] = byte[ord("a") : ord("z") + 1]
        solid = np.ones(256, np.int8)
        solid[list(SPACES)] = 0
        _made["byte"], _made["solid"] = byte, solid
    if len(_made.get("pow", ())) < n:
        size = max(n, BLOCK + 1)
        for name, b in (("pow", BASE), ("inv", pow(BASE, -1, 1 << 64))):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _made[name] = np.cumprod(p)
    return _made["byte"], _made["solid"], _made["pow"], _made["inv"]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words in order, number of words of each text); A-Z count as a-z."""
    hashes, counts = [np.empty(0, np.uint64)], np.zeros(len(texts), np.int64)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < BLOCK):
            size += len(texts[j]) + 1
            j += 1
        byte, solid, powers, inverse = _tables(size)
        a = np.frombuffer(b" ".join(texts[i:j]) + b" ", np.uint8)
        edges = np.flatnonzero(np.diff(solid[a], prepend=np.int8(0)))
        starts, ends = edges[::2], edges[1::2]
        run = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(byte[a] * powers[: len(a)], out=run[1:])
        hashes.append(mixed((run[ends] - run[starts]) * inverse[starts]))
        last = np.cumsum([len(t) + 1 for t in texts[i:j]])
        counts[i:j] = np.diff(np.searchsorted(starts, last), prepend=0)
        i = j
    return np.concatenate(hashes), counts


def chained(*parts: np.ndarray) -> np.ndarray:
    """One hash for several hashes in order."""
    h = np.zeros(len(parts[0]), np.uint64)
    for p in parts:
        h = mixed((h + np.uint64(BASE)) ^ p)
    return h
