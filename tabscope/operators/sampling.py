"""Stratified, simple and pre-sampling, rare-class top-up, splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.aggregates import join_on, small
from tabscope.functions.scalars import col, digest
from tabscope.operators.profile import category_counts
from tabscope.operators.ranking import cutoffs, one_quota, pick, pick_rows, shuffle_rows, whole, with_cutoff
from tabscope.session import MAX_GROUP_ROWS, checkpoint

# Fixed values.
DEFAULT_SEED = 42
DEFAULT_SAMPLE_SIZE = 100_000
MIN_ROWS_PER_STRATUM = 2
MIN_ROWS_PER_CLASS = 30
LARGE_GROUP_ROWS = 70_000
PRESAMPLE_ROWS = 30_000


def stratum_key(columns: Sequence[str]):
    """Display name of a stratum: the values joined by ``_``, null when one is missing."""
    return F.concat(*[x for i, c in enumerate(columns) for x in ([F.lit("_")] if i else []) + [col(c).cast("string")]])


def stratum_quotas(
    df: DataFrame, strata: Sequence[str], sample_size: int, min_rows: int = MIN_ROWS_PER_STRATUM
) -> DataFrame:
    """(strata..., count, target, needed, quota): proportional share, at least ``min_rows``, at most all."""
    counts = category_counts(df, strata)
    total = counts.select(F.sum("count")).scalar()
    return (
        counts.withColumn("target", F.col("count") / total * sample_size)
        .withColumn("needed", F.greatest(F.round("target"), F.lit(min_rows)).cast("long"))
        .withColumn("quota", F.least("needed", "count"))
    )


def stratified_sample(
    df: DataFrame, strata: Sequence[str], keys: Sequence[str] | None, sample_size: int = DEFAULT_SAMPLE_SIZE,
    seed: int = DEFAULT_SEED, min_rows: int = MIN_ROWS_PER_STRATUM, top_up: str | None = None,
    shuffled: bool = False, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact stratified sample without replacement; ``keys`` identify the rows (None: rows may repeat).

    ``top_up`` names a class column whose rare classes are filled up afterwards; ``shuffled`` puts the
    result in random order.
    """
    quotas = stratum_quotas(df, strata, sample_size, min_rows).select(*[col(s) for s in strata], "quota")
    sample = pick(df, strata, quotas, keys, seed, max_group_rows=max_group_rows)
    if top_up is not None:
        sample = top_up_rare_classes(df, sample, top_up, keys, seed, max_group_rows=max_group_rows)
    return shuffle_rows(sample, keys or sample.columns, seed) if shuffled else sample


def simple_random_sample(
    df: DataFrame, n: int, keys: Sequence[str] | None, seed: int = DEFAULT_SEED,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exactly ``n`` random rows."""
    return pick_rows(df, n, keys, seed, max_group_rows)


def presample_large_groups(
    df: DataFrame, strata: Sequence[str], keys: Sequence[str] | None, large: int = LARGE_GROUP_ROWS,
    rows: int = PRESAMPLE_ROWS, seed: int = DEFAULT_SEED, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Groups with more than ``large`` rows are reduced to ``rows``; the others stay whole."""
    quota = F.when(F.col("count") > large, F.lit(rows)).otherwise(F.col("count")).alias("quota")
    quotas = category_counts(df, strata).select(*[col(s) for s in strata], quota)
    return pick(df, strata, quotas, keys, seed, max_group_rows)


def most_common(counts: DataFrame, label: str) -> DataFrame:
    """The class with the most rows, the first by name if several tie."""
    return counts.orderBy(F.col("count").desc(), col(label)).limit(1)


def trim_class(
    df: DataFrame, label: str, removals: DataFrame, keys: Sequence[str] | None, seed: int = DEFAULT_SEED,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Remove the first ``remove`` rows (in random order) of each class listed in ``removals``.

    For a table whose rows may repeat (no ``keys``) the rows that stay are picked by their number instead.
    """
    removals = checkpoint(removals.select(col(label), F.col("remove").cast("long").alias("quota")))
    others = join_on(df, small(removals), [label], "left_anti")
    touched = join_on(df, small(removals.select(col(label))), [label], "left_semi")
    if keys is None:
        counts = category_counts(touched, [label])
        rest = join_on(counts, removals, [label]).select(col(label), (F.col("count") - F.col("quota")).alias("quota"))
        return others.unionByName(pick(touched, [label], rest, None, seed, max_group_rows))
    marked = with_cutoff(touched, [label], removals, keys, seed, max_group_rows)
    kept = marked.where(F.col("_digest") > F.col("_cut"))
    columns = [col(c) for c in df.columns]
    return others.select(*columns).unionByName(kept.select(*columns))


def top_up_plan(
    original: DataFrame, sample: DataFrame, label: str, min_rows: int = MIN_ROWS_PER_CLASS
) -> DataFrame:
    """(class, have, need, available, from_original, copies) for each class of the sample below ``min_rows``.

    Missing rows come from the original table; when that has no more than needed, all of it is taken and
    the rest are copies of rows already in the sample.
    """
    have = category_counts(sample, [label]).withColumnRenamed("count", "have")
    rare = checkpoint(have.where(F.col("have") < min_rows).withColumn("need", min_rows - F.col("have")))
    members = join_on(original.select(col(label)), small(rare.select(col(label))), [label], "left_semi")
    available = category_counts(members, [label]).withColumnRenamed("count", "available")
    enough = F.col("available") > F.col("need")
    return (
        join_on(rare, available, [label], "left")
        .withColumn("available", F.coalesce("available", F.lit(0)))
        .withColumn("from_original", F.when(enough, F.col("need")).otherwise(F.col("available")))
        .withColumn("copies", F.when(enough, F.lit(0)).otherwise(F.col("need") - F.col("available")))
    )


def top_up_rare_classes(
    original: DataFrame, sample: DataFrame, label: str, keys: Sequence[str] | None, seed: int = DEFAULT_SEED,
    min_rows: int = MIN_ROWS_PER_CLASS, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Fill every rare class up to ``min_rows`` and take as many rows from the most common class.

    Added rows may repeat rows of the sample. The sample comes back unchanged when no class is rare, when
    nothing can be added, or when the most common class is not larger than the number of added rows.
    """
    sample = checkpoint(sample)  # read several times below; drawing it again each time would rescan the table
    plan = checkpoint(top_up_plan(original, sample, label, min_rows))
    added = plan.agg(F.sum(F.col("from_original") + F.col("copies"))).first()[0] or 0
    trim = most_common(category_counts(sample, [label]), label).withColumn("remove", F.lit(added))
    if added == 0 or trim.where(F.col("count") > added).isEmpty():
        return sample

    columns = [col(c) for c in sample.columns]
    quotas = plan.where(F.col("from_original") > 0).select(col(label), F.col("from_original").alias("quota"))
    candidates = join_on(original.select(*columns), small(quotas.select(col(label))), [label], "left_semi")
    extra = pick(candidates, [label], quotas, keys, seed + 1, max_group_rows)

    copies = plan.where(F.col("copies") > 0).select(col(label), "copies", "have")
    slots = copies.withColumn("_slot", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        col(label), (F.pmod(F.col("_slot") - 1, F.col("have")) + 1).cast("int").alias("_rank")
    )
    # A rare class has fewer than min_rows rows in the sample.
    order = Window.partitionBy(col(label)).orderBy(digest(seed + 2, keys or sample.columns), *[col(k) for k in keys or []])
    existing = join_on(sample, copies.select(col(label)), [label], "left_semi")
    existing = existing.withColumn("_rank", F.row_number().over(order))
    copied = join_on(existing, slots, [label, "_rank"]).select(*columns)

    kept = trim_class(sample, label, trim.select(col(label), "remove"), keys, seed, max_group_rows)
    return kept.unionByName(extra.select(*columns)).unionByName(copied)


def random_split(
    df: DataFrame, keys: Sequence[str], train_share: float = 0.9, seed: int = DEFAULT_SEED,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``split``: exactly round(train_share * rows) random rows are ``train``, the rest ``test``.

    Rows that share a key stay on one side.
    """
    train = F.round(F.lit(train_share) * df.select(F.count(F.lit(1))).scalar())
    marked = with_cutoff(whole(df), ["_all"], one_quota(df, train), keys, seed, max_group_rows)
    return _split(marked).select(*[col(c) for c in df.columns], "split")


def _split(marked: DataFrame) -> DataFrame:
    return marked.withColumn("split", F.when(F.col("_digest") <= F.col("_cut"), "train").otherwise("test"))


def test_allocation(counts: DataFrame, label: str, test_share: float) -> DataFrame:
    """(class, count, train_rows): ceil(test_share * rows) test rows, shared out by largest remainder.

    The training rows are allotted first, as whole parts of the proportional share and then one each to
    the classes with the largest remainders (the first by name on a tie).
    """
    total = counts.select(F.sum("count")).scalar()
    train = total - F.ceil(total * test_share)
    shares = counts.withColumn("_share", F.col("count") * train / total).withColumn("_whole", F.floor("_share"))
    left = train - shares.select(F.sum("_whole")).scalar()
    remainder = F.round(F.col("_share") - F.col("_whole"), 9)
    # One row per class.
    order = Window.orderBy(remainder.desc(), col(label))
    extra = (F.row_number().over(order) <= left).cast("long")
    return shares.select(col(label), "count", (F.col("_whole") + extra).alias("train_rows"))


def stratified_split(
    df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.25, seed: int = DEFAULT_SEED,
    rare_rows: int = 0, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``split`` so that each class keeps its share in both parts.

    Classes with at most ``rare_rows`` rows are kept out of the allocation: one row trains, the rest test.
    Rows that share a key stay on one side.
    """
    counts = category_counts(df, [label])
    common = test_allocation(counts.where(F.col("count") > rare_rows), label, test_share)
    rare = counts.where(F.col("count") <= rare_rows).withColumn("train_rows", F.lit(1).cast("long"))
    quotas = common.unionByName(rare).select(col(label), F.col("train_rows").alias("quota"))
    marked = with_cutoff(df, [label], quotas, keys, seed, max_group_rows)
    return _split(marked).select(*[col(c) for c in df.columns], "split")


def rare_aware_split(
    df: DataFrame, label: str, keys: Sequence[str], test_share: float = 0.25, seed: int = DEFAULT_SEED,
    rare_rows: int = 2, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Stratified split in which a one-row class trains and a two-row class gives one row to each part."""
    return stratified_split(df, label, keys, test_share, seed, rare_rows, max_group_rows)


def stratified_folds(
    df: DataFrame, label: str, keys: Sequence[str], folds: int = 5, seed: int = DEFAULT_SEED,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``fold`` 0..folds-1; the folds of a class differ by at most one row.

    A class is cut into consecutive parts of its random order, so only the cutoffs between them are needed.
    """
    n, k = F.col("count"), F.lit(folds)
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(folds - 1)),
        lambda i: i * F.floor(n / k) + F.least(i.cast("long"), n % k),
    )
    quotas = category_counts(df, [label]).select(col(label), F.explode(ends).alias("quota"))
    quotas = checkpoint(quotas)
    cuts = join_on(quotas, cutoffs(df, [label], quotas, keys, seed, max_group_rows), [label, "quota"])
    per_class = checkpoint(cuts.groupBy(col(label)).agg(F.collect_list("cut").alias("_cuts")))
    rows = join_on(df.withColumn("_digest", digest(seed, keys)), small(per_class), [label])
    passed = F.filter("_cuts", lambda c: F.col("_digest") > c)
    return rows.withColumn("fold", F.size(passed)).drop("_digest", "_cuts")


def missing_classes(expected: DataFrame, present: DataFrame, label: str) -> DataFrame:
    """Classes of ``expected`` that do not occur in ``present``."""
    return join_on(expected.select(col(label)).distinct(), present.select(col(label)).distinct(), [label], "left_anti")
