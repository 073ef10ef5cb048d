"""Profiling: describe, null and category counts, histograms, box statistics and distribution flags.

Numeric operators work on (feature, value) rows made by ``unpivot``, so the plan does not grow with the
table's width, and aggregate partially before the shuffle: what is shuffled grows with features and
categories, not with rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.aggregates import join_on, small
from tabscope.functions.scalars import col, quoted
from tabscope.operators.columns import numeric_columns
from tabscope.operators.quantiles import exact_quantiles
from tabscope.session import MAX_GROUP_ROWS, checkpoint

# Fixed values.
NEAR_ZERO_VARIANCE = 1e-10
LARGE_STD_SHARE = 0.5
HIGH_MAX_FACTOR = 5.0
WHISKER_FACTOR = 1.5
CLIP_QUANTILE = 0.99
HISTOGRAM_BINS = 50
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def to_long(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., feature, value): one row for every cell of the numeric columns, as double."""
    wide = df.select(*[col(b) for b in by], *[col(c).cast("double").alias(c) for c in features])
    return wide.unpivot([quoted(b) for b in by], [quoted(c) for c in features], "feature", "value")


DESCRIBE_SCHEMA = (
    "feature string, count long, null_count long, mean double, std double, min double, p25 double, p50 double, "
    "p75 double, max double, min_text string, max_text string"
)


def describe(
    df: DataFrame, features: Sequence[str] | None = None, rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per column: count, null_count, mean, sample std, min, quartiles and max.

    Text, boolean, date and timestamp columns get counts and, as text, the min and max (``min_text``, ``max_text``).
    """
    names = df.columns if features is None else list(features)
    numeric = [c for c in numeric_columns(df) if c in set(names)]
    ordered = (T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    text = [f.name for f in df.schema if f.name in set(names) and isinstance(f.dataType, ordered)]
    parts = []
    if numeric:
        long = to_long(df, numeric)
        moments = long.groupBy("feature").agg(
            F.count("value").alias("count"),
            F.count_if(F.col("value").isNull()).alias("null_count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
        bound = df.count() if rows is None else rows
        quartiles = exact_quantiles(long, ["feature"], "value", QUARTILES, bound, max_group_rows)
        parts.append(
            join_on(moments, quartiles, ["feature"], "left").select(
                "feature", "count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max",
                F.lit(None).cast("string").alias("min_text"), F.lit(None).cast("string").alias("max_text"),
            )
        )
    if text:
        # Dates, timestamps and booleans sort as text like as values.
        wide = df.select(*[col(c).cast("string").alias(c) for c in text])
        long = wide.unpivot([], [quoted(c) for c in text], "feature", "value")
        empty = [F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]
        parts.append(
            long.groupBy("feature")
            .agg(
                F.count("value").alias("count"),
                F.count_if(F.col("value").isNull()).alias("null_count"),
                F.min("value").alias("min_text"),
                F.max("value").alias("max_text"),
            )
            .select("feature", "count", "null_count", *empty, "min_text", "max_text")
        )
    if not parts:
        return df.sparkSession.createDataFrame([], DESCRIBE_SCHEMA)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def describe_table(described: DataFrame) -> DataFrame:
    """The describe result turned on its side: a ``statistic`` column and one text column per feature."""
    stats = ["count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max"]
    label = {"p25": "25%", "p50": "50%", "p75": "75%"}
    fallback = {"min": "min_text", "max": "max_text"}
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(label.get(s, s)).alias("statistic"),
                (F.coalesce(F.col(s).cast("string"), F.col(fallback[s])) if s in fallback else F.col(s).cast("string"))
                .alias("value"),
            )
            for i, s in enumerate(stats)
        ]
    )
    long = described.select("feature", F.explode(cells).alias("c")).select("feature", "c.*")
    wide = long.groupBy("position", "statistic").pivot("feature").agg(F.first("value"))
    return wide.orderBy("position").drop("position")


def null_counts(df: DataFrame) -> DataFrame:
    """(feature, null_count) of every column, of any type."""
    flags = df.select(*[col(c).isNull().cast("long").alias(c) for c in df.columns])
    return (
        flags.unpivot([], [quoted(c) for c in df.columns], "feature", "is_null")
        .groupBy("feature")
        .agg(F.sum("is_null").alias("null_count"))
    )


def category_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows per category."""
    return df.groupBy(*[col(b) for b in by]).agg(F.count(F.lit(1)).alias("count"))


def category_percentages(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and percentage per category; the total is a scalar subquery over the counts."""
    counts = category_counts(df, by)
    total = counts.select(F.sum("count")).scalar()
    share = F.coalesce(F.try_divide(F.col("count").cast("double"), total), F.lit(0.0)) * 100
    return counts.withColumn("percentage", share)


def variances(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """(feature, variance, near_zero, zero, constant) by the three rules in use.

    ``near_zero``: undefined or below 1e-10; ``zero``: exactly 0; ``constant``: exactly 0 or undefined.
    """
    names = numeric_columns(df) if features is None else list(features)
    v = F.col("variance")
    undefined = v.isNull() | F.isnan(v)
    return (
        to_long(df, names)
        .groupBy("feature")
        .agg(F.var_samp("value").alias("variance"))
        .withColumn("near_zero", undefined | (F.abs(v) < NEAR_ZERO_VARIANCE))
        .withColumn("zero", F.coalesce(v == 0, F.lit(False)))
        .withColumn("constant", v.isNull() | (v == 0))
    )


def remove_zero_variance_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop numeric columns whose standard deviation is 0 or undefined, except ``keep``.

    The resulting schema depends on the data, so one aggregate runs right away.
    """
    names = numeric_columns(df, exclude=keep)
    if not names:
        return df
    constant = {r["feature"] for r in variances(df, names).where("constant").select("feature").collect()}
    return df.select(*[col(c) for c in df.columns if c not in constant])


def histogram(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = (), bins: int = HISTOGRAM_BINS,
    clip: float | None = CLIP_QUANTILE, rows: int | None = None, max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Density histogram of each feature: ``bins`` equal cells between the smallest and largest value.

    Without ``by`` the values above the ``clip`` quantile are left out first; with ``by`` every category
    has its own range and no clipping. A constant feature gets the range value -/+ 0.5. NaN and infinities are left out.
    """
    groups = [*by, "feature"]
    keys = [col(g) for g in groups]
    infinite = F.abs("value") == F.lit(float("inf"))
    long = to_long(df, features, by).where(F.col("value").isNotNull() & ~F.isnan("value") & ~infinite)
    if clip is not None and not by:
        bound = df.count() if rows is None else rows
        upper = exact_quantiles(long, groups, "value", {"upper": clip}, bound, max_group_rows)
        upper = small(checkpoint(upper), len(features))
        long = join_on(long, upper, groups).where(F.col("value") <= F.col("upper")).drop("upper")
    ends = long.groupBy(*keys).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("total")
    )
    flat = F.col("lo") == F.col("hi")
    edges = checkpoint(
        ends.select(
            *keys, "total",
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
        )
    )
    cell = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        join_on(long, small(edges), groups)
        .withColumn("bin", F.least(cell, F.lit(bins - 1)).cast("int"))
        .groupBy(*keys, "bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    width = (F.col("hi") - F.col("lo")) / bins
    return join_on(grid, counts, [*groups, "bin"], "left").select(
        *keys, "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
        (F.coalesce("count", F.lit(0)) / (F.col("total") * width)).alias("density"),
    )


def box_fences(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = (), rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """The long rows and, per group, the quartiles with the fences at 1.5 times their distance."""
    groups = [*by, "feature"]
    long = to_long(df, features, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    bound = df.count() if rows is None else rows
    quartiles = exact_quantiles(long, groups, "value", QUARTILES, bound, max_group_rows)
    reach = (F.col("p75") - F.col("p25")) * WHISKER_FACTOR
    fences = quartiles.withColumn("low_fence", F.col("p25") - reach).withColumn("high_fence", F.col("p75") + reach)
    return long, small(checkpoint(fences))


def box_statistics(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = (), rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Quartiles, whiskers (the extreme values inside the fences) and the number of outliers.

    Groups without values do not appear.
    """
    groups = [*by, "feature"]
    long, fences = box_fences(df, features, by, rows, max_group_rows)
    v = F.col("value")
    above, below = v > F.col("high_fence"), v < F.col("low_fence")
    stats = join_on(long, fences, groups).groupBy(*[col(g) for g in groups]).agg(
        F.count(F.lit(1)).alias("count"),
        F.first("p25").alias("p25"), F.first("p50").alias("p50"), F.first("p75").alias("p75"),
        F.min(F.when(~below, v)).alias("_low"), F.max(F.when(~above, v)).alias("_high"),
        F.count_if(above | below).alias("outliers"),
    )
    return stats.select(
        *[col(g) for g in groups], "count", "p25", "p50", "p75",
        F.least("_low", "p25").alias("whisker_low"), F.greatest("_high", "p75").alias("whisker_high"), "outliers",
    )


def box_outliers(
    df: DataFrame, features: Sequence[str], by: Sequence[str] = (), rows: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Distinct values outside the fences and how often each occurs."""
    groups = [*by, "feature"]
    long, fences = box_fences(df, features, by, rows, max_group_rows)
    outside = join_on(long, fences, groups).where(~F.col("value").between(F.col("low_fence"), F.col("high_fence")))
    return outside.groupBy(*[col(g) for g in groups], "value").agg(F.count(F.lit(1)).alias("count"))


def _yes(condition: Column) -> Column:
    return F.when(condition, "yes").otherwise("no")


def distribution_flags(described: DataFrame) -> DataFrame:
    """Five flags per numeric feature, decided on its describe row alone."""
    c = {n: F.col(n) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")}
    reach = (c["p75"] - c["p25"]) * WHISKER_FACTOR
    right, left = c["max"] > c["p75"] + reach, c["min"] < c["p25"] - reach
    return described.where(c["mean"].isNotNull()).select(
        "feature",
        _yes((c["mean"] == c["max"]) & (c["mean"] == c["min"])).alias("mean_max_min_equal"),
        F.when(F.abs(c["mean"] - c["p50"]) > c["std"], "large gap").otherwise("small gap").alias("mean_median_gap"),
        _yes(c["std"] >= c["mean"] * LARGE_STD_SHARE).alias("large_std"),
        _yes(c["max"] > c["p50"] * HIGH_MAX_FACTOR).alias("max_too_high"),
        F.when(right & left, "Both tails")
        .when(right, "Right long-tailed")
        .when(left, "Left long-tailed")
        .otherwise("Not long-tailed")
        .alias("long_tail_check"),
    )


def problematic_features(flags: DataFrame) -> DataFrame:
    """Features flagged for a large deviation or a high maximum, each once."""
    large = flags.where(F.col("large_std") == "yes").select("feature")
    high = flags.where(F.col("max_too_high") == "yes").select("feature")
    return large.unionByName(high).distinct()


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight of each class: rows / (classes * rows of the class)."""
    counts = category_counts(df, [label])
    total = counts.select(F.sum("count")).scalar()
    classes = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (classes * F.col("count")))


def class_moments(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Mean, population std and count of each feature in each class."""
    return (
        to_long(df, features, [label])
        .groupBy(col(label), "feature")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.count("value").alias("count"))
    )
