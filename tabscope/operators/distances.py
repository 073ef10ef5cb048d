"""Nearest-neighbour distances inside and between the two sides of a binary label."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.scalars import col, fill_zero
from tabscope.operators.neighbours import BallIndex, distances, matrix
from tabscope.operators.ranking import pick_rows
from tabscope.session import checkpoint, ship

# Rows of a block. Every block of one side meets every block of the other, so larger ones are sent fewer times.
BLOCK_ROWS = 4096
# At most so many parts of blocks on each side, until one holds ``PART_BLOCKS``; a task takes two parts.
PARTS, PART_BLOCKS = 64, 32
# Distances computed at a time; squares below this share of the two lengths are computed again from the differences.
CHUNK, CLOSE = 1 << 19, 1e-3


def feature_array(features: Sequence[str]) -> Column:
    return F.array(*[fill_zero(col(c)) for c in features])


def _blocks(points: DataFrame, name: str) -> DataFrame:
    """Rows (id, vector) gathered into blocks of at most ``BLOCK_ROWS``: their ids, and their vectors as the bytes of a matrix."""
    most = BLOCK_ROWS
    count = max(1, -(-points.count() // (most - most // 8)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held.append(batch.slice(at, most - n))
                n, at = n + held[-1].num_rows, at + held[-1].num_rows
                if n == most:
                    yield _block(held, name)
                    held, n = [], 0
        if held:
            yield _block(held, name)

    parts = max(min(count, PARTS), -(-count // PART_BLOCKS))
    # Dealt out evenly, so that rows with one id do not fill a block.
    return checkpoint(points.repartition(parts).mapInArrow(pack, f"{name}_ids array<string>, {name}_rows binary"))


def _block(held: list[pa.RecordBatch], name: str) -> pa.RecordBatch:
    ids = pa.array([[i for batch in held for i in batch.column("id").to_pylist()]], pa.list_(pa.string()))
    rows = np.concatenate([matrix(batch.column("vector")) for batch in held])
    return pa.RecordBatch.from_arrays([ids, pa.array([rows.astype("<f8").tobytes()])], [f"{name}_ids", f"{name}_rows"])


def _sum_of_distances(x: np.ndarray, y: np.ndarray, mine: np.ndarray, other: np.ndarray) -> tuple[float, int]:
    """Total and number of the distances between the rows of two matrices; rows with the same number of an id are no pair.

    Squared distances are one matrix product, of rows seen from the middle of ``y``. Where the two lengths nearly cancel,
    and where a square overflows, they come from the differences.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        middle = y.mean(0)
        u, v = x - middle, y - middle
        long, wide = (u * u).sum(1), (v * v).sum(1)
        plain = not np.append(long, wide).max() < 1e300
    left = np.column_stack([u, long, np.ones(len(u))])
    right = np.column_stack([-2 * v, np.ones(len(v)), wide]).T
    met = np.isin(mine, other)
    total, n = 0.0, 0
    step = max(1, CHUNK // len(y))
    for low in range(0, len(x), step):
        part = slice(low, low + step)
        if plain:
            d = distances(x[part], y, "euclidean")
        else:
            d = left[part] @ right
            q, p = np.nonzero(d <= CLOSE * (long[part, None] + wide.max()))
            close = d[q, p] <= CLOSE * (long[part][q] + wide[p])
            q, p = q[close], p[close]
            if len(q):
                exact = np.zeros(len(q))
                for i in range(x.shape[1]):
                    gap = x[part][q, i] - y[p, i]
                    exact += gap * gap
                d[q, p] = exact
            np.sqrt(d, out=d)
        n += d.size
        if met[part].any():
            same = mine[part, None] == other
            d[same] = 0
            n -= int(same.sum())
        total += float(d.sum())
    return total, n


def _block_distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each pair of blocks: total and number of the distances between rows with different ids."""
    for batch in batches:
        for k in range(batch.num_rows):
            sides = [batch.column(f"{side}_ids").slice(k, 1).flatten() for side in "ab"]
            x, y = (np.frombuffer(batch.column(f"{side}_rows")[k].as_py(), "<f8").reshape(len(ids), -1) for side, ids in zip("ab", sides, strict=True))
            names = pa.concat_arrays(sides).dictionary_encode().indices.to_numpy()
            total, n = _sum_of_distances(x, y, names[: len(x)], names[len(x) :])
            yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n])], ["total", "n"])


def distances_to(a: DataFrame, b: DataFrame) -> DataFrame:
    """(total, n) in a few rows, whose sums are those of the distances of all rows of ``a`` to all rows of ``b`` with another id.

    Both sides are (id string, vector). They are cut into blocks, and every block of ``a`` meets every block of ``b``. Blocks
    are written once and read by each task that needs them, and a pair of blocks returns one row: neither pairs of rows nor
    copies of a side are ever written. The total of all distances needs every distance, so the work is rows x rows.
    """
    ship(a.sparkSession)
    pairs = _blocks(a, "a").hint("shuffle_replicate_nl").crossJoin(_blocks(b, "b"))
    return pairs.mapInArrow(_block_distances, "total double, n long")


def distinct_vectors(points: DataFrame) -> DataFrame:
    """(part, key, vector, low, high): each vector of (id, vector) once, with its smallest and largest id."""
    ids = points.groupBy("vector").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return checkpoint(ids.select(F.lit("").alias("part"), F.col("low").alias("key"), "vector", "low", "high"))


def nearest_others(a: DataFrame, b: DataFrame, index: BallIndex | None = None) -> DataFrame:
    """(vector, nearest): how far the nearest row of ``b`` with another id is from the rows of each vector of ``a``; null
    without one.

    Both sides come from ``distinct_vectors``, so copies cost one look-up: their distance is 0 if ``b`` has two ids with the
    vector, or another than the row's. The rest is found through balls around pivots (``BallIndex``, of ``b``): no pairs of
    rows are emitted, and balls out of reach are not visited.
    """
    found = (index or BallIndex(b)).nearest(a).select("key", "nearest")
    other = b.select(F.col("vector").alias("v"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    known = a.join(found, "key").join(other, F.col("vector") == F.col("v"), "left")
    # A vector with one id in both tables meets only itself; with more, each of its rows meets another one.
    single = (F.col("low") == F.col("high")) & (F.col("b_low") == F.col("b_high")) & (F.col("low") == F.col("b_low"))
    copied = F.col("v").isNotNull() & ~single
    return known.select("vector", F.when(copied, 0.0).otherwise(F.col("nearest")).alias("nearest"))


def neighbour_diagnosis(
    df: DataFrame, label: str, keys: Sequence[str], vector: Column, seed: int = 42, malicious_rows: int | None = None,
) -> DataFrame:
    """(metric, value) of distances between benign (0) rows, malicious (1) rows and across.

    Nearest neighbour inside the benign rows: min, max, mean; inside the malicious rows: mean; across: the
    smallest, and the mean of all. All rows of both sides count; ``malicious_rows`` draws that many malicious rows by the
    seeded digest of their keys. Nearest neighbours and means are exact. The mean across has no form that spares pairs: its
    work is rows x rows.
    """
    identity = F.concat_ws("_", *[col(k).cast("string") for k in keys]).alias("id")
    benign = df.where(col(label) == 0)
    malicious = df.where(col(label) == 1)
    drawn = malicious if malicious_rows is None else pick_rows(malicious, malicious_rows, keys, seed)
    points = [side.select(identity, vector.alias("vector")) for side in (benign, drawn)]
    # How many rows have each vector, for means over rows.
    sizes = [side.groupBy("vector").agg(F.count(F.lit(1)).alias("rows")) for side in points]
    (one, two), indexes = [distinct_vectors(side) for side in points], []
    for side in (one, two):
        indexes.append(None if side.isEmpty() else BallIndex(side))

    def nearest(a: DataFrame, b: DataFrame, index: BallIndex | None, rows: DataFrame) -> DataFrame:
        if index is None:
            return a.select(F.lit(None).cast("double").alias("nearest"), F.lit(1).alias("rows"))
        return nearest_others(a, b, index).join(rows, "vector").select("nearest", "rows")

    average = F.sum(F.col("nearest") * F.col("rows")) / F.sum(F.when(F.col("nearest").isNotNull(), F.col("rows")))
    inside = nearest(one, one, indexes[0], sizes[0]).agg(
        F.min("nearest").alias("benign_nearest_min"), F.max("nearest").alias("benign_nearest_max"), average.alias("benign_nearest_mean")
    )
    other = nearest(two, two, indexes[1], sizes[1]).agg(average.alias("malicious_nearest_mean"))
    across = nearest(one, two, indexes[1], sizes[0]).agg(F.min("nearest").alias("cross_min"))
    mean = distances_to(*points).agg((F.sum("total") / F.sum("n")).alias("cross_mean"))
    parts = [part.unpivot([], part.columns, "metric", "value") for part in (inside, other, across, mean)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
