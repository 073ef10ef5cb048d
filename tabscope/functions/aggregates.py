"""Aggregate expressions and joins that several operators share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.scalars import col


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation, null (not an error) when a side is constant.

    Both sides must be present: filter out rows with a missing side first.
    """
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


# A table of at most this many narrow rows may be sent to every executor.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, bound: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``BROADCAST_ROWS`` rows, otherwise unchanged.

    ``bound`` is a known upper bound of its rows; without one they are counted, so pass a table that is
    cheap to count, such as a checkpointed one.
    """
    rows = df.count() if bound is None else bound
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join whose keys match null with null; the keys of ``left`` are kept.

    Without a hint on ``right`` the optimizer picks the strategy from measured sizes and splits skewed keys.
    """
    if not keys:
        raise ValueError("join_on needs at least one key")
    renamed = {k: f"__{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(renamed)
    condition = F.lit(True)
    for k, alias in renamed.items():
        condition = condition & col(k).eqNullSafe(F.col(alias))
    return left.join(other, condition, how).drop(*renamed.values())


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    """Row count of the largest group: one aggregate that reads the key columns only."""
    if not keys:
        return df.count()
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0
