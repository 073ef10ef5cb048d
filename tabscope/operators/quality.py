"""How well a sample keeps the class distributions of the table it was drawn from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.scalars import col
from tabscope.session import checkpoint


def class_shares(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(target, class, percentage, rows) of every target column from one scan, as a table of a few rows.

    The rows are counted once per combination of the targets; everything else follows from those counts.
    """
    counts = checkpoint(df.groupBy(*[col(t) for t in targets]).agg(F.count(F.lit(1)).alias("_n")))
    total = F.coalesce(F.sum("_n"), F.lit(0))
    rows = counts.agg(total).first()[0]
    result = None
    for t in targets:
        share = F.coalesce(F.try_divide(F.sum("_n").cast("double"), F.lit(rows)), F.lit(0.0)) * 100
        part = counts.groupBy(col(t).alias("class")).agg(share.alias("percentage"))
        part = part.select(F.lit(t).alias("target"), F.col("class").cast("string"), "percentage", F.lit(rows).alias("rows"))
        result = part if result is None else result.unionByName(part)
    return checkpoint(result)


def _compared(before: DataFrame, after: DataFrame) -> DataFrame:
    """(target, class, original_pct, sample_pct): full outer join of two tables of shares, missing ones as 0."""
    left = before.select("target", "class", F.col("percentage").alias("original_pct"))
    right = after.select("target", "class", F.col("percentage").alias("sample_pct"))
    return left.join(right, ["target", "class"], "full").fillna(0.0, ["original_pct", "sample_pct"])


def _similarity(compared: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(target, similarity) in the given order of targets; one without a class counts as equal."""
    closeness = F.greatest(F.lit(0.0), 100 - F.abs(F.col("original_pct") - F.col("sample_pct")))
    found = compared.groupBy("target").agg(F.avg(closeness).alias("mean"))
    named = compared.sparkSession.createDataFrame([(t,) for t in targets], "target string")
    return named.join(found, "target", "left").select(
        "target", F.round(F.coalesce("mean", F.lit(100.0)), 2).alias("similarity")
    )


def _rows(shares: DataFrame) -> int:
    return shares.agg(F.max("rows")).first()[0] or 0


def _overall(similarity: DataFrame, rows_before: int, rows_after: int) -> DataFrame:
    reduction = (1 - rows_after / rows_before) * 100 if rows_before else 0.0
    return similarity.agg(F.round(F.avg("similarity"), 2).alias("overall_quality")).select(
        "overall_quality", F.lit(rows_before).cast("long").alias("rows_before"),
        F.lit(rows_after).cast("long").alias("rows_after"), F.round(F.lit(reduction), 2).alias("size_reduction"),
    )


def _printed(compared: DataFrame) -> DataFrame:
    return compared.select(
        "target",
        F.substring("class", 1, 15).alias("class"),
        F.format_string("%.1f%%", F.col("original_pct")).alias("original_pct"),
        F.format_string("%.1f%%", F.col("sample_pct")).alias("sample_pct"),
    )


def distribution_comparison(original: DataFrame, sample: DataFrame, target: str) -> DataFrame:
    """(class, original_pct, sample_pct): full outer join of the two distributions, missing ones as 0."""
    kind = original.select(col(target)).schema[0].dataType
    compared = _compared(class_shares(original, [target]), class_shares(sample, [target]))
    return compared.select(F.col("class").cast(kind), "original_pct", "sample_pct")


def distribution_similarity(original: DataFrame, sample: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(target, similarity): mean over the classes of 100 minus the difference in percentage points."""
    return _similarity(_compared(class_shares(original, targets), class_shares(sample, targets)), targets)


def overall_quality(original: DataFrame, sample: DataFrame, targets: Sequence[str]) -> DataFrame:
    """One row: overall quality, row counts before and after, and the size reduction in percent."""
    before, after = class_shares(original, targets), class_shares(sample, targets)
    return _overall(_similarity(_compared(before, after), targets), _rows(before), _rows(after))


def comparison_table(original: DataFrame, sample: DataFrame, targets: Sequence[str]) -> DataFrame:
    """(target, class, original_pct, sample_pct) as printed: 15 characters and one decimal."""
    return _printed(_compared(class_shares(original, targets), class_shares(sample, targets)))


def quality_report(original: DataFrame, sample: DataFrame, targets: Sequence[str]) -> DataFrame:
    """The report as text lines in one column, in order; both tables are read once."""
    before, after = class_shares(original, targets), class_shares(sample, targets)
    compared = _compared(before, after)
    similarity = _similarity(compared, targets)
    overall = _overall(similarity, _rows(before), _rows(after))
    table = _printed(compared)
    position = {t: i for i, t in enumerate(targets)}
    section = F.create_map(*[F.lit(x) for pair in position.items() for x in pair])[F.col("target")]
    heads = similarity.select(
        section.alias("section"), F.lit(0).alias("part"),
        F.format_string("%s: distribution similarity %.2f%%", "target", "similarity").alias("value"),
    )
    body = table.select(
        section.alias("section"), F.lit(1).alias("part"),
        F.format_string("  %-15s %8s %8s", "class", "original_pct", "sample_pct").alias("value"),
    )
    foot = overall.select(
        F.lit(len(targets)).alias("section"), F.lit(0).alias("part"),
        F.format_string(
            "Overall quality: %.2f%%, size reduction: %.1f%% (from %d to %d rows)",
            "overall_quality", "size_reduction", "rows_before", "rows_after",
        ).alias("value"),
    )
    return heads.unionByName(body).unionByName(foot).orderBy("section", "part", "value").select("value")
