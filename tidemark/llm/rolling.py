"""Vectorised rolling hashes over concatenated symbol sequences, and the anchors (content-chosen trigger positions) cut from them.

Everything here is plain numpy over one bounded block; Spark decides which rows reach which task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK = 1 << 16
_MASK = np.uint64(BLOCK * 2 - 1)
_ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash, applied to a uint64 array."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


_tables: dict[tuple, tuple] = {}


def _powers(which: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64, their inverses, and a random value for each byte."""
    if which not in _tables:
        base, n = _ODD[which], 2 * BLOCK + 1
        up, down = (np.empty(n, np.uint64) for _ in range(2))
        for out, b in ((up, base), (down, pow(base, -1, 1 << 64))):
            out[0] = 1
            out[1:] = np.uint64(b)
            np.multiply.accumulate(out, out=out)
        _tables[which] = up, down, mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD[1 - which]))
    return _tables[which]


class Hashes:
    """Hashes of any slice of one block in O(1) each, from prefix sums modulo 2**64."""

    def __init__(self, symbols: np.ndarray, which: int = 0):
        self.up, down, table = _powers(which)
        values = table[symbols] if symbols.dtype == np.uint8 else mix(symbols + np.uint64(_ODD[which]))
        self.sums = np.zeros(len(symbols) + 1, np.uint64)
        np.cumsum(values * down[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each slice [start, end)."""
        return mix((self.sums[end] - self.sums[start]) * self.up[start])

    def every(self, width: int) -> np.ndarray:
        """Hash of the slice of this width at each position that has one."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.up[:n]) if n > 0 else np.empty(0, np.uint64)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of this many values."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    rows = -(-len(x) // width)
    grid = np.full(rows * width, np.iinfo(x.dtype).max, x.dtype)
    grid[: len(x)] = x
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def blocks(lengths: Iterable[int], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Cuts sequences into blocks of at most BLOCK symbols: lists of (sequence, start, end).

    A sequence longer than a block continues in the next one, overlapping by window - 1 symbols, so each window lies in exactly one piece.
    """
    block, room = [], BLOCK
    for k, n in enumerate(lengths):
        if n < window:
            continue
        start = 0
        while True:
            if room < window or room < min(n - start, BLOCK // 2):
                yield block
                block, room = [], BLOCK
            end = min(n, start + room)
            block.append((k, start, end))
            room -= end - start
            if end == n:
                break
            start = end - window + 1
    if block:
        yield block


def anchors(symbols: np.ndarray, pieces: list[tuple[int, int, int]], window: int, gram: int) -> dict[str, np.ndarray]:
    """The runs of windows that choose one anchor.

    Of the grams inside a window, the one with the smallest rolling hash (first, at ties) is its anchor, so equal windows choose the same place.
    Returned per run: its piece, h (hash of the anchor's gram), c (independent hash of all the run's windows cover, with the anchor's place), first (start of the first window) and count (of windows).
    Windows never span two pieces.
    """
    one, two = Hashes(symbols, 0), Hashes(symbols, 1)
    h = one.every(gram)
    at = sliding_min((h & ~_MASK) | np.arange(len(h), dtype=np.uint64), window - gram + 1) & _MASK
    edge = np.cumsum([0] + [e - s for _, s, e in pieces])
    good = np.zeros(len(at) + 1, bool)
    for s, e in zip(edge[:-1], edge[1:], strict=True):
        good[s : e - window + 1] = True
    starts = np.flatnonzero(good[:-1])
    if not len(starts):
        empty = np.empty(0, np.int64)
        return {"piece": empty, "h": empty, "c": empty, "first": empty, "count": empty}
    at = at[starts].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    first, last, at = starts[new], starts[np.append(new[1:], len(starts)) - 1], at[new]
    c = mix(two.of(first, last + window) + (at - first).astype(np.uint64) * np.uint64(_ODD[0]))
    piece = np.searchsorted(edge, first, "right") - 1
    return {"piece": piece, "h": h[at].view(np.int64), "c": c.view(np.int64), "first": first - edge[piece] + np.array([s for _, s, _ in pieces])[piece], "count": last - first + 1}


def offset_runs(symbols: np.ndarray, window: int, gram: int, step: int) -> tuple[np.ndarray, ...]:
    """Cuts all that the windows of one anchor cover into runs of windows by the anchor's offset in them, `step` offsets to a run.

    Returned per run: its number, core (hash of what any window of these offsets covers around the anchor), cover (independent hash of all
    that the run's windows cover, with its place), first (start of the first window) and count (of windows).
    """
    one, two = Hashes(symbols, 0), Hashes(symbols, 1)
    at, last = int(np.argmin(one.every(gram)[: window - gram + 1] & ~_MASK)), len(symbols) - window
    p = np.arange((at - last) // step, at // step + 1)
    head = at - p * step
    first, end = np.maximum(head - step + 1, 0), np.minimum(head, last)
    core = one.of(head, head - step + 1 + window)
    cover = mix(two.of(first, end + window) + (at - first).astype(np.uint64) * np.uint64(_ODD[0]))
    return p.astype(np.int32), core.view(np.int64), cover.view(np.int64), first.astype(np.int32), (end - first + 1).astype(np.int32)
