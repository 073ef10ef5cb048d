"""A run-length grammar of many short strings at once, by recompression, and longest common extensions in it."""

from __future__ import annotations

import numpy as np

from tabscope.llm.arrays import U64, mix


class Grammar:
    """Levels of one array of symbols; block and pair compression take turns from each level to the next.

    The first ``fixed`` symbols are separators: each occurs once and is never compressed, so no symbol covers parts of
    two strings. Block compression gives each maximal block of a repeated symbol one name; pair compression names each
    neighbouring pair whose left symbol falls on the left side and right symbol on the right side. Sides depend on the
    symbol alone, so equal stretches are parsed alike but for one symbol at each end. Levels are made when a query
    first gets to them.
    """

    def __init__(self, symbols: np.ndarray, fixed: int) -> None:
        self.symbols = [symbols.astype(np.int64)]
        self.parent: list[np.ndarray] = []  # of each symbol, in the next level
        self.first: list[np.ndarray] = []  # child of each symbol of the next level, and the end
        self.blocks: list[bool] = []
        self._fixed, self._next, self._round = fixed, int(symbols.max(initial=-1)) + 1, 0

    def _add(self, starts: np.ndarray, several: np.ndarray, keys: np.ndarray, blocks: bool) -> None:
        """A level whose symbols begin at ``starts``; those in ``several`` get a new name for each distinct key."""
        below = self.symbols[-1]
        names = below[starts]
        distinct, number = np.unique(keys, return_inverse=True)
        names[several] = self._next + number
        self._next += len(distinct)
        lead = np.zeros(len(below), np.int32)
        lead[starts] = 1
        self.parent.append(np.cumsum(lead, dtype=np.int32) - np.int32(1))
        self.first.append(np.append(starts, len(below)))
        self.blocks.append(blocks)
        self.symbols.append(names)

    def _compress_blocks(self) -> None:
        below = self.symbols[-1]
        starts = np.flatnonzero(np.append(True, below[1:] != below[:-1]))
        sizes = np.diff(np.append(starts, len(below)))
        several = np.flatnonzero(sizes > 1)
        if len(several):
            self._add(starts, several, (below[starts[several]] << 32) | sizes[several], True)

    def _compress_pairs(self) -> None:
        below = self.symbols[-1]
        right = (mix(below.astype(U64) * U64(2) + U64(1) + U64(self._round << 40)) >> U64(33)) & U64(1) == 1
        free = below >= self._fixed
        self._round += 1
        second = np.zeros(len(below), bool)
        second[1:] = (free & ~right)[:-1] & (free & right)[1:]
        if second.any():
            starts = np.flatnonzero(~second)
            several = np.flatnonzero(np.append(second[1:], False)[starts])
            at = starts[several]
            self._add(starts, several, (below[at] << 32) | below[at + 1], False)

    def _grow(self) -> bool:
        """One more level; False if every string is one symbol."""
        levels = len(self.symbols)
        if not self.blocks or not self.blocks[-1]:
            self._compress_blocks()
        while len(self.symbols) == levels:
            free = self.symbols[-1] >= self._fixed
            if not (free[1:] & free[:-1]).any():
                return False
            self._compress_pairs()
        return True

    def extensions(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols from ``a`` and ``b`` on (``back``: before them, going left) are equal, for a <> b.

        A query climbs while its symbols are equal and both stand at the start of their parents, passing at most one
        symbol or block a level, and goes down again at the first difference, with the same step.
        """

        def symbol(level: int, at: np.ndarray) -> np.ndarray:
            row = self.symbols[level]
            return row[len(row) - 1 - at] if back else row[at]

        def up(level: int, at: np.ndarray) -> np.ndarray:
            row = self.parent[level]
            return len(self.symbols[level + 1]) - 1 - row[len(row) - 1 - at] if back else row[at].astype(np.int64)

        def child(level: int, at: np.ndarray) -> np.ndarray:
            row = self.first[level]
            return row[-1] - row[len(row) - 1 - at] if back else row[at]

        def step(level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray | int:
            left = lambda at: child(level, up(level, at) + 1) - at
            return np.minimum(left(x), left(y)) if self.blocks[level] else 1

        size = len(self.symbols[0])
        x, y = (size - a, size - b) if back else (a.astype(np.int64), b.astype(np.int64))
        begin, row = x, np.arange(len(x))
        stops: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = []
        while len(row):
            level = len(stops)
            stops.append([])
            equal = symbol(level, x) == symbol(level, y)
            stops[level].append((row[~equal], x[~equal], y[~equal]))
            row, x, y = row[equal], x[equal], y[equal]
            if not len(row):
                break
            if level == len(self.first) and not self._grow():
                raise AssertionError("equal places in a string of one symbol")
            inner = (child(level, up(level, x)) != x) | (child(level, up(level, y)) != y)
            if inner.any():
                move = step(level, x[inner], y[inner])
                x, y = x.copy(), y.copy()
                x[inner] += move
                y[inner] += move
                inner = (child(level, up(level, x)) != x) | (child(level, up(level, y)) != y)
                stops[level].append((row[inner], x[inner], y[inner]))
                row, x, y = row[~inner], x[~inner], y[~inner]
            x, y = up(level, x), up(level, y)

        row, x, y = (np.zeros(0, np.int64) for _ in range(3))
        for level in range(len(stops) - 1, -1, -1):
            if len(row):
                x, y = child(level, x), child(level, y)
                equal = symbol(level, x) == symbol(level, y)
                move = step(level, x[equal], y[equal])
                x[equal] += move
                y[equal] += move
            row, x, y = (np.concatenate([old, *more]) for old, more in zip((row, x, y), zip(*stops[level], strict=True), strict=True))
        out = np.zeros(len(a), np.int64)
        out[row] = x - begin[row]
        return out
