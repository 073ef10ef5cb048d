"""Exact linear-interpolated quantiles per group, for groups of any size.

Groups up to ``max_group_rows`` use the built-in exact ``percentile``, which keeps a value-to-count map
per group. Larger groups are narrowed instead: every pass counts values in equal-width cells of the
bracket that holds a wanted rank, and the next pass looks only inside the cell that contains it. A pass
shuffles cell counts, never rows, so one feature with 10^12 values needs two or three scans and no task
ever holds more than ``max_group_rows`` values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.aggregates import join_on, largest_group, small
from tabscope.functions.scalars import col
from tabscope.session import MAX_GROUP_ROWS, checkpoint

CELLS = 4096
MAX_PASSES = 12


def exact_quantiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    quantiles: dict[str, float],
    rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per group with a column for each named quantile of the present (not null, not NaN) values.

    ``rows`` is an upper bound of the largest group, if known; otherwise it is counted.
    """
    present = df.where(col(value).isNotNull() & ~F.isnan(col(value)))
    if rows is None:
        rows = largest_group(present, groups)
    if rows <= max_group_rows:
        wanted = F.array(*[F.lit(float(p)) for p in quantiles.values()])
        found = present.groupBy(*[col(g) for g in groups]).agg(F.percentile(col(value), wanted).alias("_q"))
        return found.select(
            *[col(g) for g in groups], *[F.col("_q")[i].alias(n) for i, n in enumerate(quantiles)]
        )
    return _narrowed(present, list(groups), value, quantiles, max_group_rows)


def _narrowed(
    present: DataFrame, groups: list[str], value: str, quantiles: dict[str, float], max_group_rows: int
) -> DataFrame:
    """Find the two order statistics around every quantile, then interpolate."""
    keys = [col(g) for g in groups]
    ends = present.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("inside"), F.min(col(value)).alias("lo"), F.max(col(value)).alias("hi")
    )
    wanted = F.array(
        *[F.struct(F.lit(n).alias("quantile"), F.lit(float(p)).alias("p")) for n, p in quantiles.items()]
    )
    position = F.col("p") * (F.col("inside") - 1)
    ranks = (
        ends.withColumn("_w", F.explode(wanted))
        .select("*", "_w.quantile", "_w.p")
        .withColumn("share", position - F.floor(position))
        .withColumn(
            "_k",
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("side"), F.floor(position).alias("k")),
                    F.struct(F.lit(1).alias("side"), F.ceil(position).alias("k")),
                )
            ),
        )
        .select(*keys, "quantile", "share", "_k.side", "_k.k", "lo", "hi", F.lit(0).cast("long").alias("below"), "inside")
    )
    for step in range(MAX_PASSES + 1):
        ranks = checkpoint(ranks)
        unresolved = ranks.where(F.col("lo") < F.col("hi"))
        largest = unresolved.agg(F.max("inside")).first()[0]
        if largest is None:
            break
        # A bracket that is still large after many passes holds few distinct floating-point values.
        last = largest <= max_group_rows or step == MAX_PASSES
        narrowed = _narrow(present, unresolved, groups, value, last)
        ranks = ranks.where(F.col("lo") == F.col("hi")).unionByName(narrowed)
        if last:
            ranks = checkpoint(ranks)
            break
    low = F.max(F.when(F.col("side") == 0, F.col("lo")))
    high = F.max(F.when(F.col("side") == 1, F.col("lo")))
    between = F.when(low == high, low).otherwise(low + (high - low) * F.max("share"))
    per_quantile = ranks.groupBy(*keys, "quantile").agg(between.alias("_v"))
    return per_quantile.groupBy(*keys).pivot("quantile", list(quantiles)).agg(F.first("_v"))


def _narrow(
    present: DataFrame, ranks: DataFrame, groups: list[str], value: str, last: bool
) -> DataFrame:
    """Replace each rank's bracket by the cell (or, in the last pass, the value) that holds the rank."""
    bracket = [*groups, "lo", "hi"]
    brackets = ranks.select(*[col(c) for c in bracket]).distinct()
    inside = join_on(present.select(*[col(c) for c in [*groups, value]]), small(brackets), groups).where(
        col(value).between(F.col("lo"), F.col("hi"))
    )
    if last:
        cell = col(value)
    else:
        share = F.nanvl((col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")), F.lit(0.0))
        cell = (
            F.when(col(value) <= F.col("lo"), 0)
            .when(col(value) >= F.col("hi"), CELLS + 1)
            .otherwise(F.least(F.floor(share * CELLS), F.lit(CELLS - 1)) + 1)
        )
    cells = (
        inside.withColumn("_cell", cell)
        .groupBy(*[col(c) for c in bracket], "_cell")
        .agg(
            F.count(F.lit(1)).alias("_n"), F.min(col(value)).alias("_lo"), F.max(col(value)).alias("_hi")
        )
    )
    before = Window.partitionBy(*[col(c) for c in bracket]).orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    rank_in_bracket = F.col("k") - F.col("below")
    return (
        join_on(ranks, cells.drop("_cell"), bracket)
        .where((rank_in_bracket >= F.col("_before")) & (rank_in_bracket < F.col("_before") + F.col("_n")))
        .select(
            *[col(g) for g in groups], "quantile", "share", "side", "k",
            F.col("_lo").alias("lo"), F.col("_hi").alias("hi"),
            (F.col("below") + F.col("_before")).alias("below"), F.col("_n").alias("inside"),
        )
    )
