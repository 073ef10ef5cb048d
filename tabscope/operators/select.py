"""Feature selection: groups of correlated features and one representative for each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.operators.columns import numeric_columns
from tabscope.operators.components import connected_components
from tabscope.operators.correlate import HIGH_CORRELATION


def correlation_groups(pairs: DataFrame, threshold: float = HIGH_CORRELATION, signed: bool = True) -> DataFrame:
    """(feature, group): transitive groups of features linked by r >= threshold.

    ``signed=False`` also links strongly negative pairs. A group is named after its first feature by name.
    """
    strength = F.col("correlation") if signed else F.abs("correlation")
    linked = pairs.where(strength >= threshold)
    return connected_components(linked, "feature1", "feature2").select(
        F.col("node").alias("feature"), F.col("component").alias("group")
    )


def target_scores(long: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(feature, score): sum of |r| with the targets."""
    return (
        long.where(F.col("feature1").isin(*targets) & ~F.col("feature2").isin(*targets))
        .groupBy(F.col("feature2").alias("feature"))
        .agg(F.sum(F.abs("r")).alias("score"))
    )


def group_representatives(
    groups: DataFrame, scores: DataFrame | None, targets: Sequence[str] = ()
) -> DataFrame:
    """(group, kept_feature): the member with the highest score; the first by name on a tie or without scores."""
    members = groups.where(~F.col("feature").isin(*targets)) if targets else groups
    if scores is None:
        scored = members.withColumn("score", F.lit(0.0))
    else:
        # Scores equal up to rounding noise count as a tie.
        scored = members.join(scores, "feature", "left").withColumn(
            "score", F.round(F.coalesce("score", F.lit(0.0)), 9)
        )
    return scored.groupBy("group").agg(
        F.min_by("feature", F.struct(-F.col("score"), F.col("feature"))).alias("kept_feature")
    )


def feature_selection(
    df: DataFrame, pairs: DataFrame, scores: DataFrame | None, targets: Sequence[str],
    threshold: float = HIGH_CORRELATION, drop: Sequence[str] = (), signed: bool = True,
) -> DataFrame:
    """(feature, status, kept_feature) for every numeric column and target.

    Status is ``selected`` or ``dropped``; a dropped feature names the one kept from its group. Columns in
    ``drop`` are not considered at all.
    """
    skip = {*drop, *targets}
    numeric = [c for c in numeric_columns(df) if c not in skip]
    names = numeric + [t for t in targets if t in df.columns]
    features = df.sparkSession.createDataFrame([(n,) for n in names], "feature string")
    groups = correlation_groups(pairs, threshold, signed)
    groups = groups.where(~F.col("feature").isin(*skip)) if skip else groups
    kept = groups.join(group_representatives(groups, scores, targets), "group").select("feature", "kept_feature")
    keep = F.col("kept_feature").isNull() | (F.col("kept_feature") == F.col("feature"))
    return features.join(kept, "feature", "left").select(
        "feature",
        F.when(keep, "selected").otherwise("dropped").alias("status"),
        F.coalesce("kept_feature", "feature").alias("kept_feature"),
    )


def selected_columns(df: DataFrame, selection: DataFrame) -> list[str]:
    """Names of the selected columns in table order."""
    chosen = {r["feature"] for r in selection.where(F.col("status") == "selected").select("feature").collect()}
    return [c for c in df.columns if c in chosen]
