"""Seeded random picks that are exact, whatever the size and skew of the strata.

Every random choice of the package is "the first rows of a stratum in the order of a digest of seed and
row key". The order does not depend on partitioning, and the pick is exact: no Bernoulli sampling.

A pick needs one number per stratum: the digest of its last picked row, the cutoff. Given the cutoffs,
choosing or splitting rows is a filter with a join on a table of one row per stratum; nothing else is
shuffled. In large strata the cutoff is found by narrowing: count the rows per leading
digits of the digest (4096 cells per stratum, combined before the shuffle), keep the cell that holds the
wanted row, and look inside that cell only. Two or three such passes over the key columns serve 10^12
rows, and no task ever sorts a stratum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.aggregates import join_on, largest_group, small
from tabscope.functions.scalars import col, digest
from tabscope.session import MAX_GROUP_ROWS, checkpoint

DIGITS_PER_PASS = 3
MAX_DIGITS = 12
# Below this many rows, looking at every digest is cheaper than another narrowing pass.
DIRECT_ROWS = 50_000
# Hex digests sort between these two.
BEFORE_ALL = ""
AFTER_ALL = "g"


def _running(parts: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*[col(p) for p in parts]).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def cutoffs(
    df: DataFrame, strata: Sequence[str], quotas: DataFrame, keys: Sequence[str], seed: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """(strata..., quota, cut, below): the digest of the ``quota``-th row of each stratum.

    ``below`` rows come before it. A quota beyond the stratum gives a cutoff after, a quota of 0 one before
    all rows. ``quotas`` (strata..., quota) may name several quotas for a stratum.
    """
    strata = list(strata)
    rows = df.select(*[col(s) for s in strata], digest(seed, keys).alias("_digest"))
    wanted = checkpoint(quotas.select(*[col(s) for s in strata], F.col("quota").cast("long").alias("quota")).distinct())
    targets = wanted.where(F.col("quota") > 0).select("*", F.lit("").alias("_prefix"), F.lit(0).cast("long").alias("below"))
    largest = largest_group(df, strata)
    digits = 0
    while largest > min(max_group_rows, DIRECT_ROWS) and digits < MAX_DIGITS:
        targets = checkpoint(_narrow(rows, targets, strata, digits, digits + DIGITS_PER_PASS))
        digits += DIGITS_PER_PASS
        largest = targets.agg(F.max("_inside")).first()[0] or 0
    found = _narrow(rows, targets, strata, digits, 32).select(
        *[col(s) for s in strata], "quota", F.col("_prefix").alias("cut"), "below"
    )
    beyond = F.when(F.col("quota") > 0, F.lit(AFTER_ALL)).otherwise(F.lit(BEFORE_ALL))
    return checkpoint(
        join_on(wanted, found, [*strata, "quota"], "left")
        .withColumn("cut", F.coalesce("cut", beyond))
        .withColumn("below", F.coalesce("below", F.lit(0)))
    )


def _narrow(rows: DataFrame, targets: DataFrame, strata: list[str], digits: int, deeper: int) -> DataFrame:
    """Extend each target's prefix to ``deeper`` digits, following the cell that holds its row."""
    inside = rows
    if digits == 0:
        inside = inside.withColumn("_prefix", F.lit(""))
    else:
        inside = inside.withColumn("_prefix", F.substring("_digest", 1, digits))
        prefixes = targets.select(*[col(s) for s in strata], "_prefix").distinct()
        inside = join_on(inside, small(prefixes), [*strata, "_prefix"], "left_semi")
    cell = F.substring("_digest", 1, deeper).alias("_cell")
    cells = inside.groupBy(*[col(s) for s in strata], "_prefix", cell).agg(F.count(F.lit(1)).alias("_n"))
    parts = [*strata, "_prefix"]
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(_running(parts, "_cell")), F.lit(0)))
    rank = F.col("quota") - F.col("below")
    return (
        join_on(targets.drop("_inside"), cells, parts)
        .where((rank > F.col("_before")) & (rank <= F.col("_before") + F.col("_n")))
        .select(
            *[col(s) for s in strata], "quota", F.col("_cell").alias("_prefix"),
            (F.col("below") + F.col("_before")).alias("below"), F.col("_n").alias("_inside"),
        )
    )


def with_cutoff(
    df: DataFrame, strata: Sequence[str], quotas: DataFrame, keys: Sequence[str], seed: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``_digest`` and the stratum's ``_quota``, ``_cut`` and ``_below``; strata without a quota disappear."""
    cuts = cutoffs(df, strata, quotas, keys, seed, max_group_rows)
    cuts = cuts.select(*[col(s) for s in strata], *[F.col(c).alias(f"_{c}") for c in ("quota", "cut", "below")])
    return join_on(df.withColumn("_digest", digest(seed, keys)), small(cuts), strata)


def pick(
    df: DataFrame, strata: Sequence[str], quotas: DataFrame, keys: Sequence[str] | None, seed: int,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exactly ``quota`` rows of every stratum (all rows when it has fewer).

    ``keys`` must identify the rows. Without keys the whole row is the key and rows may repeat: copies of
    the row at the cutoff are then counted, not gathered, and given out up to the quota.
    """
    columns = [col(c) for c in df.columns]
    marked = with_cutoff(df, strata, quotas, df.columns if keys is None else keys, seed, max_group_rows)
    if keys is not None:
        return marked.where(F.col("_digest") <= F.col("_cut")).select(*columns)
    sure = marked.where(F.col("_digest") < F.col("_cut")).select(*columns)
    at = marked.where(F.col("_digest") == F.col("_cut")).withColumn("_take", F.col("_quota") - F.col("_below"))
    copies = at.groupBy(*columns, "_take").agg(F.count(F.lit(1)).alias("_n"))
    # Distinct rows that share the digest of the cutoff: one, unless they differ only in what is null.
    window = Window.partitionBy(*[col(s) for s in strata]).orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    given = F.least(F.col("_n"), F.greatest(F.lit(0), F.col("_take") - F.coalesce(F.sum("_n").over(window), F.lit(0))))
    repeated = copies.withColumn("_given", given).where(F.col("_given") > 0)
    shared = repeated.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_given")))).select(*columns)
    return sure.unionByName(shared)


def whole(df: DataFrame) -> DataFrame:
    """Add ``_all``, the one stratum of a table without strata."""
    return df.withColumn("_all", F.lit(0))


def one_quota(df: DataFrame, n: int | Column) -> DataFrame:
    """The quota table of that one stratum; ``n`` is a number or a scalar expression."""
    value = F.lit(n) if isinstance(n, int) else n
    return df.sparkSession.range(1).select(F.lit(0).alias("_all"), value.cast("long").alias("quota"))


def pick_rows(
    df: DataFrame, n: int, keys: Sequence[str] | None, seed: int, max_group_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Exactly ``n`` rows of the whole table (all rows when it has fewer)."""
    return pick(whole(df), ["_all"], one_quota(df, n), keys, seed, max_group_rows).drop("_all")


def shuffle_rows(df: DataFrame, keys: Sequence[str], seed: int) -> DataFrame:
    """All rows in the seeded random order (a range-partitioned sort)."""
    return df.orderBy(digest(seed, keys), *[col(k) for k in keys])
