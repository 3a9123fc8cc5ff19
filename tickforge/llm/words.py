"""Hashes of the words of many texts at once, on NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15            # odd, so it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = []
#: Bytes of text hashed at a time (a longer word makes its block longer).
BLOCK = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS.clear()
        for b in (_BASE, inverse):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
    return _POWERS


def _block(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, starts) of the words of a block that begins and ends at white space or an edge."""
    inside = ~_SPACES[buf]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), starts
    power, inverse = _powers(max(len(buf), BLOCK))
    total = np.empty(len(buf) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_BYTE[buf] * power[:len(buf)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    """For each text (null: empty) the 64-bit hashes of its words ``[^\\x20\\x09-\\x0D]+``,
    A-Z in lower case, in order.  Texts are hashed together up to ``BLOCK`` bytes; longer ones in pieces."""
    batch, size = [], 0
    for t in texts:
        b = (t or "").encode("utf-8", "replace")
        if batch and size + len(b) > BLOCK:
            yield from _together(batch)
            batch, size = [], 0
        if len(b) > BLOCK:
            yield _long(np.frombuffer(b, np.uint8))
        else:
            batch.append(b)
            size += len(b) + 1
    yield from _together(batch)


def _together(batch: list[bytes]) -> Iterator[np.ndarray]:
    if not batch:
        return
    h, starts = _block(np.frombuffer(b"\n".join(batch), np.uint8))
    bounds = np.cumsum([len(b) + 1 for b in batch])
    lo = 0
    for hi in np.searchsorted(starts, bounds):
        yield h[lo:hi]
        lo = hi


def _long(buf: np.ndarray) -> np.ndarray:
    out, at = [], 0
    while at < len(buf):
        to = min(len(buf), at + BLOCK)
        while to < len(buf) and not _SPACES[buf[to]]:
            gap = np.flatnonzero(_SPACES[buf[to:to + BLOCK]])
            to = to + int(gap[0]) if len(gap) else min(len(buf), to + BLOCK)
        out.append(_block(buf[at:to])[0])
        at = to
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of fewer words, of the whole sequence; of none, none."""
    n = len(words)
    if not n:
        return words
    w = min(k, n)
    h = np.full(n - w + 1, 0x2545F4914F6CDD1D * (w if n < k else 0) & (1 << 64) - 1, np.uint64)
    for j in range(w):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + words[j:n - w + 1 + j])
    return np.unique(h)
