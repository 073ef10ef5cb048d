"""Exact neighbours without all pairs: points in balls around pivots, balls pruned by the triangle inequality."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.session import checkpoint, ship

# At most so many pivots, picked by hash; they decide how much is pruned and nothing else.
PIVOTS = 1024
# Points that one task holds at once: those of a group of balls; larger balls are dealt to several.
BALL_ROWS = 20_000
# Distances computed at a time, and the part of a distance that rounding may be off.
BLOCK, SLACK = 1 << 20, 1e-9

_POINT = "part string, group int, block int, role int, ball int, key string, vector array<double>, reach double, near double"


def distances(x: np.ndarray, y: np.ndarray, metric: str) -> np.ndarray:
    """All distances between the rows of two matrices: ``euclidean``, or ``chebyshev`` (the largest difference)."""
    out = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        step = np.abs(x[:, i, None] - y[None, :, i])
        if metric == "euclidean":
            out += step * step
        else:
            np.maximum(out, step, out=out)
    return np.sqrt(out) if metric == "euclidean" else out


def close_pairs(x: np.ndarray, y: np.ndarray, metric: str, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance) of all pairs within ``reach`` (one for each row of x); without it a choice of pairs that
    holds, for each row of x, the nearest row of y at a positive distance.

    Euclidean pairs are chosen by one matrix product, with room for its rounding; the distances are those of ``distances``.
    """
    long, wide = (x * x).sum(1), (y * y).sum(1)
    if metric == "euclidean" and len(y) and np.append(long, wide).max() < 1e300:
        off = (8 + x.shape[1]) * 4 * np.finfo(float).eps * (long + wide.max()) + 1e-290
        # Squared distances as one product: long - 2 x y + wide.
        square = np.column_stack([x, long, np.ones(len(x))]) @ np.column_stack([-2 * y, np.ones(len(y)), wide]).T
        if reach is None:
            limit = square.min(1)
            same = np.flatnonzero(limit <= off)
            limit[same] = np.where(square[same] > off[same, None], square[same], np.inf).min(1)
            limit += 2 * off
        else:
            limit = np.where(reach >= 0, reach * reach * (1 + 1e-9) + off, -np.inf)
        q, p = np.nonzero(square <= limit[:, None])
        total = np.zeros(len(q))
        for i in range(x.shape[1]):
            step = np.abs(x[q, i] - y[p, i])
            total += step * step
        d = np.sqrt(total)
        inside = slice(None) if reach is None else d <= reach[q]
        return q[inside], p[inside], d[inside]
    d = distances(x, y, metric)
    if reach is not None:
        q, p = np.nonzero(d <= reach[:, None])
    else:
        q = np.arange(len(x) if len(y) else 0)
        p = np.where(d > 0, d, np.inf).argmin(1) if len(y) else q
    return q, p, d[q, p]


def _met_balls(to: np.ndarray, radius: np.ndarray, reach: np.ndarray, near: np.ndarray, home: np.ndarray, own: str) -> np.ndarray:
    """Which balls each query has to meet, by its distances to their pivots, its reach and its distance to the nearest pivot."""
    if own == "only":
        return home
    slack = SLACK * (1 + to)
    go = (to - radius <= reach[:, None] + slack) & (to - near[:, None] <= 2 * reach[:, None] + slack)
    return go & ~home if own == "not" else go | home


def matrix(column: pa.Array) -> np.ndarray:
    """Arrays of one length as the rows of a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


class BallIndex:
    """Points (``part`` string, ``key`` string, ``vector``) under the ball of their nearest pivot.

    Vectors have one length; equal vectors should be one point, keys are unique. Points of different parts are never
    neighbours. Pivots are points. A query at distance d from a ball's pivot, e from that of its own ball, has its
    neighbours within r only in balls with d - radius <= r and d - e <= 2 r; others are not visited. What is sent to
    the tasks are the pivots and two numbers for each, at most ``PIVOTS`` rows. A query travels once for each group of balls:
    where vectors are long and balls do not tell them apart, that is once for ``BALL_ROWS`` points and not once for a ball.
    """

    def __init__(self, points: DataFrame, metric: str = "euclidean") -> None:
        self.spark, self.metric = points.sparkSession, metric
        ship(self.spark)
        points = points.select("part", "key", F.col("vector").cast("array<double>").alias("vector"))
        # Several in the order of a hash of the key, so that a bounded number is collected whatever the table.
        wanted = int(min(PIVOTS, max(1, points.count() ** 0.5)))
        chosen = points.orderBy(F.xxhash64("key"), "key").limit(wanted).select("vector").collect()
        self.pivots = np.unique(np.array([r[0] for r in chosen], float).reshape(len(chosen), -1), axis=0)
        self.points = checkpoint(self._located(points))
        balls = self.points.groupBy("ball").agg(F.max("reach"), F.count(F.lit(1))).collect()
        self.radius, sizes = np.full(len(self.pivots), -np.inf), np.zeros(len(self.pivots), np.int64)
        for ball, radius, rows in balls:
            self.radius[ball], sizes[ball] = radius, rows
        self._group(sizes)

    def _group(self, sizes: np.ndarray) -> None:
        """The group of each ball, neighbours in the widest direction of the pivots, and how many blocks each group has: one,
        or for a single ball above ``BALL_ROWS`` several."""
        self.groups, blocks, filled = np.zeros(len(sizes), np.int32), [0], 0
        for ball in self._order():
            if filled and filled + sizes[ball] > BALL_ROWS:
                blocks, filled = [*blocks, 0], 0
            filled += int(sizes[ball])
            self.groups[ball], blocks[-1] = len(blocks) - 1, max(1, -(-filled // BALL_ROWS))
        self.blocks = np.array(blocks, np.int64)

    def _order(self) -> np.ndarray:
        centred = self.pivots - self.pivots.mean(0)
        if not centred.size or not np.isfinite(centred @ centred.T).all():
            return np.arange(len(self.pivots))
        return np.argsort(centred @ np.linalg.svd(centred, full_matrices=False)[2][0], kind="stable")

    def _each(self, df: DataFrame, work: Callable[[pa.RecordBatch, np.ndarray, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
        """``work`` on batches with the matrix of their vectors and its distances to the pivots."""
        pivots, metric = self.spark.sparkContext.broadcast(self.pivots), self.metric

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                step = max(1, BLOCK // max(1, len(pivots.value)))
                for at in range(0, batch.num_rows, step):
                    part = batch.slice(at, step)
                    rows = matrix(part.column("vector"))
                    yield work(part, rows, distances(rows, pivots.value, metric))

        return df.mapInArrow(run, schema)

    def _located(self, points: DataFrame) -> DataFrame:
        """Points with their ball and ``reach``, the distance to its pivot."""

        def work(part: pa.RecordBatch, rows: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [part.column("part"), pa.array(to.argmin(1).astype(np.int32)), part.column("key"), part.column("vector"), pa.array(to.min(1))],
                ["part", "ball", "key", "vector", "reach"],
            )

        return self._each(points, work, "part string, ball int, key string, vector array<double>, reach double")

    def _met(self, queries: DataFrame, own: str, found: Callable, schema: str) -> DataFrame:
        """``found(pairs, keys of the points, keys of the queries)`` for every block of points and the queries sent to it;
        ``pairs(nearest)`` gives (query, point, distance), see ``close_pairs``.

        ``queries``: part, key, vector, reach. With ``own`` = "only" they meet their own ball, with "not" all others
        within reach, with "also" all within reach. Neighbouring balls form groups of about ``BALL_ROWS`` points; a query is
        sent once to a group, however many of its balls are within reach, and meets only those.
        """
        metric, context = self.metric, self.spark.sparkContext
        shared = context.broadcast((self.pivots, self.radius, self.groups, self.blocks))

        def route(part: pa.RecordBatch, rows: np.ndarray, to: np.ndarray) -> pa.RecordBatch:
            _, radius, groups, blocks = shared.value
            reach = part.column("reach").to_numpy(zero_copy_only=False)
            home, near = to.argmin(1), to.min(1)
            go = _met_balls(to, radius, reach, near, home[:, None] == np.arange(len(radius)), own) & np.isfinite(radius)
            wanted = np.zeros((len(to), len(blocks)), bool)
            for ball in range(len(radius)):
                wanted[:, groups[ball]] |= go[:, ball]
            row, group = np.nonzero(wanted)
            times = blocks[group]
            block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, group = np.repeat(row, times), np.repeat(group, times)
            take = pa.array(row)
            return pa.RecordBatch.from_arrays(
                [part.column("part").take(take), pa.array(group.astype(np.int32)), pa.array(block.astype(np.int32)), pa.array(np.ones(len(row), np.int32)),
                 pa.array(home[row].astype(np.int32)), part.column("key").take(take), part.column("vector").take(take), pa.array(reach[row]), pa.array(near[row])],
                ["part", "group", "block", "role", "ball", "key", "vector", "reach", "near"],
            )

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots, radius, _, _ = shared.value
            place, held = None, []
            for batch in batches:
                if not batch.num_rows:
                    continue
                columns = [batch.column(c) for c in ("part", "group", "block", "role")]
                codes = [c.dictionary_encode().indices.to_numpy(zero_copy_only=False) for c in columns]
                change = np.zeros(batch.num_rows, bool)
                for code in codes:
                    change[1:] |= code[1:] != code[:-1]
                cuts = np.flatnonzero(np.append(np.append(True, change[1:]), True))
                for at, to in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    here = tuple(c[at].as_py() for c in columns)
                    if place != here[:3]:
                        place, held = here[:3], []
                    some = batch.slice(at, to - at)
                    rows, names = matrix(some.column("vector")), some.column("key")
                    balls, reach, near = (some.column(c).to_numpy(zero_copy_only=False) for c in ("ball", "reach", "near"))
                    if here[3] == 0:
                        held.append((rows, names, balls))
                    elif held:
                        if len(held) > 1:
                            held = [(np.concatenate([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]), np.concatenate([h[2] for h in held]))]
                        points, keys, ball_of = held[0]
                        present, first = np.unique(ball_of, return_index=True)  # points come in the order of their balls
                        ends = np.append(first[1:], len(ball_of))
                        step = max(1, BLOCK // max(len(present), int((ends - first).max())))
                        for low in range(0, len(rows), step):
                            part = slice(low, low + step)
                            x, far = rows[part], reach[part]
                            go = _met_balls(distances(x, pivots[present], metric), radius[present], far, near[part], balls[part, None] == present, own)

                            def pairs(nearest: bool, x=x, far=far, go=go, points=points, first=first, ends=ends) -> Iterator[tuple]:
                                for k in np.flatnonzero(go.any(0)):
                                    one = np.flatnonzero(go[:, k])
                                    q, p, d = close_pairs(x[one], points[first[k] : ends[k]], metric, None if nearest else far[one])
                                    yield one[q], p + first[k], d

                            yield from found(pairs, keys, names.slice(low, step))

        at = lambda values, index: F.element_at(F.lit(values.tolist()), index + 1)
        points = self.points.withColumn("group", at(self.groups, F.col("ball")))
        block = F.pmod(F.xxhash64("key"), at(self.blocks, F.col("group"))).cast("int")
        points = points.select("part", "group", block.alias("block"), F.lit(0).alias("role"), "ball", "key", "vector", "reach", F.lit(0.0).alias("near"))
        sent = self._each(queries.select("part", "key", "vector", "reach"), route, _POINT)
        both = points.unionByName(sent).repartition("part", "group", "block").sortWithinPartitions("part", "group", "block", "role", "ball")
        return both.mapInArrow(meet, schema)

    def nearest(self, queries: DataFrame) -> DataFrame:
        """(part, key, nearest): the distance of each query to the nearest point of its part at a positive distance.

        Queries are (part, key, vector) with unique keys. They first meet the points of their own ball, which gives
        them a short reach, and then all other balls within it. Null where the part has no such point.
        """
        queries = queries.select("part", "key", F.col("vector").cast("array<double>").alias("vector"))

        def found(pairs: Callable, keys: pa.Array, names: pa.Array) -> Iterator[pa.RecordBatch]:
            best = np.full(len(names), np.inf)
            for q, _, d in pairs(True):
                np.minimum.at(best, q, np.where(d > 0, d, np.inf))
            yield pa.RecordBatch.from_arrays([names, pa.array(best)], ["key", "nearest"])

        schema = "key string, nearest double"
        best = lambda df: df.groupBy("key").agg(F.min("nearest").alias("nearest"))
        far = F.lit(float("inf"))
        home = best(self._met(queries.withColumn("reach", far), "only", found, schema))
        placed = queries.join(home, "key", "left").withColumn("reach", F.coalesce("nearest", far)).drop("nearest")
        placed = checkpoint(placed)
        away = self._met(placed, "not", found, schema)
        known = placed.select("part", "key", F.col("reach").alias("first"))
        out = known.join(best(away), "key", "left")
        value = F.least("first", F.coalesce("nearest", far))
        return out.select("part", "key", F.when(value < far, value).alias("nearest"))

    def touching(self, radius: float) -> DataFrame:
        """(a, b): edges between keys that connect the same points as all pairs of one part within ``radius`` do.

        Each task thins its pairs to a forest, so their number stays near that of the points.
        """

        def found(pairs: Callable, keys: pa.Array, names: pa.Array) -> Iterator[pa.RecordBatch]:
            names_of = pa.concat_arrays([names, keys])
            for q, p, _ in pairs(False):
                low, high = _forest(q, p + len(names), len(names_of))
                yield pa.RecordBatch.from_arrays([names_of.take(pa.array(low)), names_of.take(pa.array(high))], ["a", "b"])

        queries = self.points.select("part", "key", "vector", F.lit(float(radius)).alias("reach"))
        return self._met(queries, "also", found, "a string, b string").where("a <> b").distinct()


def _forest(a: np.ndarray, b: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """One edge from each node to the smallest node that it is connected with."""
    label = np.arange(nodes)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            other = np.flatnonzero(label != np.arange(nodes))
            return label[other], other
        label = new
