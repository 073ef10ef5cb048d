"""K-d trees over small count vectors, searched by boxes with separate bounds for what is added and what is taken away."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

LEAF = 32


class KdTree:
    """Splits of ``points`` (rows of small whole numbers), each by the column with the greatest variance at its median.

    With ``leaves`` the largest parts are split until there are so many, and boxes are the regions that the splits cut
    out, so that any vector lies in one leaf. Without it parts are split down to ``LEAF`` points, and boxes fit the points.
    """

    def __init__(self, points: np.ndarray, leaves: int | None = None) -> None:
        self.points = points.astype(np.int16)
        self.split: list[tuple[int, int] | None] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        width = points.shape[1]
        self._node(np.arange(len(points)), np.zeros(width, np.int16), np.full(width, np.iinfo(np.int16).max, np.int16), leaves is None)
        parts = [(-len(points), 0)]
        left = leaves
        while parts and (left is None or left > 1):
            size, node = heapq.heappop(parts)
            if -size <= LEAF and leaves is None or not self._cut(node, leaves is None):
                continue
            parts_of = self.children[node]
            for child in parts_of:
                heapq.heappush(parts, (-len(self.rows[child]), child))
            left = None if left is None else left - 1
        self.leaf_number = {node: k for k, node in enumerate(i for i, c in enumerate(self.children) if c is None)}

    def _node(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray, tight: bool) -> int:
        if tight and len(rows):
            low, high = self.points[rows].min(0), self.points[rows].max(0)
        for column, value in ((self.split, None), (self.children, None), (self.rows, rows), (self.low, low), (self.high, high)):
            column.append(value)
        return len(self.rows) - 1

    def _cut(self, node: int, tight: bool) -> bool:
        rows = self.rows[node]
        if len(rows) < 2:
            return False
        part = self.points[rows]
        column = int(part.var(0).argmax())
        values = part[:, column]
        top = int(values.max())
        if top == values.min():
            return False
        at = min(int(np.median(values)), top - 1)
        left = values <= at
        high, low = self.high[node].copy(), self.low[node].copy()
        high[column], low[column] = at, at + 1
        self.split[node] = (column, at)
        self.children[node] = (self._node(rows[left], self.low[node], high, tight), self._node(rows[~left], low, self.high[node], tight))
        self.rows[node] = rows[:0]
        return True

    def near(self, queries: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves (node numbers) with the queries that may become a point there by adding at most ``up`` and taking at
        most ``down``; boxes further away are left with all below them."""
        queries = queries.astype(np.int16)
        todo = [(0, np.arange(len(queries)))]
        while todo:
            node, rows = todo.pop()
            part = queries[rows]
            more = np.maximum(self.low[node] - part, 0).sum(1)
            less = np.maximum(part - self.high[node], 0).sum(1)
            rows = rows[(more <= up) & (less <= down)]
            if not len(rows):
                continue
            if self.children[node] is None:
                yield node, rows
            else:
                todo += [(child, rows) for child in self.children[node]]

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The number of the leaf in whose region each vector lies."""
        out = np.zeros(len(vectors), np.int32)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if self.children[node] is None:
                out[rows] = self.leaf_number[node]
            else:
                column, at = self.split[node]
                left = vectors[rows, column] <= at
                todo += [(self.children[node][0], rows[left]), (self.children[node][1], rows[~left])]
        return out

    def pairs(self, queries: np.ndarray, up: int, down: int, block: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and points within these bounds, as row numbers."""
        queries = queries.astype(np.int16)
        for node, rows in self.near(queries, up, down):
            here = self.rows[node]
            most = max(1, block // max(1, len(here) * queries.shape[1]))
            points = self.points[here]
            for at in range(0, len(rows), most):
                some = rows[at : at + most]
                part = queries[some]
                shared = np.minimum(part[:, None, :], points[None]).sum(2, dtype=np.int32)
                fits = (points.sum(1, dtype=np.int32)[None] - shared <= up) & (part.sum(1, dtype=np.int32)[:, None] - shared <= down)
                q, p = np.nonzero(fits)
                yield some[q], here[p]
