"""Words and byte runs of many texts at once, with hashes that depend on content alone."""

from __future__ import annotations

import numpy as np

U = np.uint64
_ODD = U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _inverse(odd: int) -> int:
    x = odd
    for _ in range(6):
        x = x * (2 - odd * x) % (1 << 64)
    return x


_BASE = 0x2545F4914F6CDD1D | 5
_powers_now: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the longest run so far."""
    if len(_powers_now[0]) < size:
        size = max(1 << 16, size + size // 8)
        for k, factor in enumerate((_BASE, _inverse(_BASE))):
            grown = np.full(size, U(factor))
            grown[0] = 1
            _powers_now[k] = np.cumprod(grown)
    return _powers_now


def byte_values(data: np.ndarray, seed: int = 0) -> np.ndarray:
    return mix((np.arange(256, dtype=U) + U(1)) * _ODD + U(seed))[data]


class PrefixHash:
    """Polynomial prefix hashes of a run of 64-bit values: the hash of any part in a few steps."""

    def __init__(self, values: np.ndarray):
        up, self.down = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, U)
        np.cumsum(values * up[: len(values)], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Equal for equal values; not mixed."""
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def runs(self, width: int) -> np.ndarray:
        """`raw` of each run of `width` values, as many as fit."""
        n = max(0, len(self.sums) - width)
        return (self.sums[width:] - self.sums[:n]) * self.down[:n]


def table(separators: bytes) -> np.ndarray:
    """Which bytes are parts of words."""
    out = np.ones(256, bool)
    out[np.frombuffer(separators, np.uint8)] = False
    return out


#: Words are runs of bytes other than ASCII white space.
NOT_SPACE = table(b" \t\n\v\f\r")


def words(
    data: np.ndarray, ends: np.ndarray, part_of_word: np.ndarray = NOT_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of texts that lie one after the other, and the first word of each text (with the end)."""
    inside = part_of_word[data]
    before = np.empty_like(inside)
    before[:1] = False
    before[1:] = inside[:-1]
    limits = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
    before[limits] = False
    start = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[limits - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, ends)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    return mix(PrefixHash(byte_values(data, seed)).raw(start, end) + (end - start).astype(U) * _ODD)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of `n` hashes (n a power of two), as many as fit."""
    width = 1
    while width < n:
        if len(h) <= width:
            return h[:0]
        h = mix(h[:-width] * _ODD + h[width:])
        width *= 2
    return h


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of `width` values, as many as fit."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out


_PLACE = U((1 << 24) - 1)
_CHUNK = 1 << 16


def stretches(
    g: np.ndarray, first: np.ndarray, window: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts, gathered into stretches that share an anchor.

    The anchor of a window of `window` units is its run of `gram` units of the
    least hash `g`, the leftmost of equals: equal windows have equal anchors at
    equal places. Returns per stretch its first window, its number of windows
    and the place of its anchor. `first` has the first unit of each text, and
    the end. No window crosses texts.
    """
    total = int(first[-1])
    starts, anchors = [], []
    kind = np.int32 if total < 1 << 31 else np.int64
    room = np.repeat(first[1:].astype(kind), np.diff(first)) - np.arange(total, dtype=kind)
    width = window - gram + 1
    for a in range(0, max(0, total - window + 1), _CHUNK):
        b = min(a + _CHUNK, total - window + 1)
        part = g[a : b + width - 1]
        low = sliding_min((part & ~_PLACE) | np.arange(len(part), dtype=U), width)
        ok = np.flatnonzero(room[a:b] >= window)
        starts.append(ok + a)
        anchors.append((low[ok] & _PLACE).astype(np.int64) + a)
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    start, anchor = np.concatenate(starts), np.concatenate(anchors)
    if not len(start):
        return start, start, start
    cut = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
    return start[cut], np.diff(np.concatenate([cut, [len(start)]])), anchor[cut]
