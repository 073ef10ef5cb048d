"""Writing results: Parquet, CSV, tab-separated, text reports and nested JSON metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.functions.scalars import col


# The lines of the text reports.
KEPT_LINE = "%s: represented by %s"
SUMMARY_LINES = {
    "analyzed": "Association with the label, features looked at: %d",
    "strong": "|r| above 0.3: %d",
    "moderate": "|r| above 0.1, up to 0.3: %d",
    "significant": "p below 0.05: %d",
}
FEATURE_LINE = "%s, r %s, p %s, effect size %s"
VARIANCE_LINES = {
    "original_features": "Original features: %d",
    "reduced_features": "Reduced features: %d",
    "feature_reduction_pct": "Feature reduction: %.1f%%",
    "variance_at_reduced_count": "Variance explained at the reduced count: %.2f%%",
    "orig_components_for_80pct": "Components needed for 80%% variance (original): %d",
    "reduced_components_for_80pct": "Components needed for 80%% variance (reduced): %d",
}


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", single: bool = False) -> None:
    """Header line and values; ``single`` writes one file, for small result tables."""
    out = df.coalesce(1) if single else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_tsv(df: DataFrame, path: str, single: bool = True) -> None:
    write_csv(df, path, "\t", single)


def write_lines(df: DataFrame, path: str) -> None:
    """A text report: the one string column of a small, ordered table."""
    df.coalesce(1).write.mode("overwrite").text(path)


def write_metrics_json(metrics: DataFrame, path: str, by: Sequence[str] = ("task", "dataset")) -> None:
    """Long rows (by..., metric, value) as one JSON object per group, with the metrics nested in it."""
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", "value"))))
    nested = metrics.groupBy(*[col(b) for b in by]).agg(entries.alias("metrics"))
    nested.coalesce(1).write.mode("overwrite").json(path)


CLASS_METRICS = "struct<status:string,precision:double,recall:double,f1:double,support:bigint,training_samples:bigint>"


def write_class_json(results: DataFrame, path: str, by: Sequence[str] = ("dataset", "task")) -> None:
    """Rows (by..., class, metrics...) as one JSON object per group, with an object of metrics for each class nested in it."""
    metrics = F.struct(*[col(c) for c in results.columns if c not in (*by, "class")])
    # A name is given to a missing class, because keys of objects cannot be null.
    entry = F.struct(F.coalesce(F.col("class").cast("string"), F.lit("null")).alias("class"), metrics.alias("metrics"))
    nested = results.groupBy(*[col(b) for b in by]).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("classes"))
    nested.write.mode("overwrite").json(path)


def read_class_json(spark: SparkSession, path: str, by: Sequence[str] = ("dataset", "task")) -> DataFrame:
    """The rows of ``write_class_json`` again, with the metrics of ``evaluate.class_results``."""
    schema = ", ".join([*[f"`{b}` string" for b in by], f"classes map<string,{CLASS_METRICS}>"])
    rows = spark.read.schema(schema).json(path).select(*[col(b) for b in by], F.explode("classes").alias("class", "m"))
    return rows.select(*[col(b) for b in by], "class", "m.*")


def group_lines(groups: DataFrame) -> DataFrame:
    """One line per feature group with its members in name order."""
    members = F.array_join(F.array_sort(F.collect_list("feature")), ", ")
    lines = groups.groupBy("group").agg(members.alias("members"))
    return lines.orderBy("group").select(F.concat_ws(": ", F.col("group"), F.col("members")).alias("value"))


def selection_lines(selection: DataFrame, status: str) -> DataFrame:
    """One line per selected or dropped feature; dropped ones name the feature kept instead."""
    chosen = selection.where(F.col("status") == status).orderBy("feature")
    kept = F.format_string(KEPT_LINE, "feature", "kept_feature")
    return chosen.select((kept if status == "dropped" else F.col("feature")).alias("value"))


def _lines(df: DataFrame, formats: dict[str, str]) -> DataFrame:
    """(position, value): one formatted line per named column of a one-row table."""
    lines = F.array(*[F.format_string(text, name) for name, text in formats.items()])
    return df.select(F.posexplode(lines).alias("position", "value"))


def association_lines(summary: DataFrame, association: DataFrame, n: int = 10) -> DataFrame:
    """Counts, then the ``n`` strongest features, as text lines."""
    strength = F.abs("point_biserial_corr")
    texts = [F.col(c).cast("string") for c in ("point_biserial_corr", "corr_p_value", "cohens_d")]
    top = association.orderBy(strength.desc_nulls_last(), "feature").limit(n).select(
        F.lit(1).alias("part"), (-F.coalesce(strength, F.lit(-1.0))).alias("position"),
        F.format_string(FEATURE_LINE, "feature", *texts).alias("value"),
    )
    counts = _lines(summary, SUMMARY_LINES).select(F.lit(0).alias("part"), F.col("position").cast("double"), "value")
    return counts.unionByName(top).orderBy("part", "position", "value").select("value")


def variance_lines(summary: DataFrame) -> DataFrame:
    """The principal-component summary as text lines."""
    return _lines(summary, VARIANCE_LINES).orderBy("position").select("value")
