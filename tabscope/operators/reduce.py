"""Principal components: how much variance the reduced feature set keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.scalars import col
from tabscope.operators.columns import fill_numeric
from tabscope.operators.ranking import pick_rows

# Fixed values.
WANTED_SHARE = 0.8


def scaled_vectors(df: DataFrame, features: Sequence[str], out: str = "scaled", keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., out): the features with gaps as 0, z-scored, as one vector column."""
    numbered = {f"_c{i}": c for i, c in enumerate(features)}
    plain = fill_numeric(df.select(*[col(k) for k in keep], *[col(c).cast("double").alias(n) for n, c in numbered.items()]), list(numbered))
    vectors = VectorAssembler(inputCols=list(numbered), outputCol="_v").transform(plain).select(*[col(k) for k in keep], "_v")
    return StandardScaler(inputCol="_v", outputCol=out, withMean=True).fit(vectors).transform(vectors).drop("_v")


def explained_variance(df: DataFrame, features: Sequence[str], components: int) -> list[float]:
    """Share of the variance explained by each of the first components of the z-scored features."""
    vectors = scaled_vectors(df, features)
    return [float(x) for x in PCA(k=components, inputCol="scaled", outputCol="pc").fit(vectors).explainedVariance]


def pca_variance(
    original: DataFrame, features: Sequence[str], reduced: Sequence[str], keys: Sequence[str] = (),
    sample_size: int | None = None, seed: int = 42,
) -> DataFrame:
    """(dataset, component, explained, cumulative) for all components of the original and the reduced features.

    All rows are used; ``sample_size`` draws that many rows by ``keys`` first.
    """
    rows = original if sample_size is None else pick_rows(original, sample_size, keys, seed)
    result = []
    for name, columns in (("original", features), ("reduced", reduced)):
        total = 0.0
        for i, share in enumerate(explained_variance(rows, columns, len(columns)), 1):
            total += share
            result.append((name, i, share, total))
    return original.sparkSession.createDataFrame(
        result, "dataset string, component int, explained double, cumulative double"
    )


def pca_summary(
    variance: DataFrame, original_features: int, reduced_features: int, wanted: float = WANTED_SHARE
) -> DataFrame:
    """One row: reduction in percent, variance kept at the reduced count (null if unknown), components for 80 %."""
    of = F.col("dataset")
    reached = F.col("cumulative") >= wanted
    at_count = F.max(
        F.when((of == "original") & (F.col("component") == reduced_features), F.col("cumulative") * 100)
    )
    return variance.agg(
        F.lit(original_features).alias("original_features"),
        F.lit(reduced_features).alias("reduced_features"),
        F.lit(round((1 - reduced_features / original_features) * 100, 1)).alias("feature_reduction_pct"),
        F.round(at_count, 2).alias("variance_at_reduced_count"),
        F.min(F.when((of == "original") & reached, F.col("component"))).alias("orig_components_for_80pct"),
        F.min(F.when((of == "reduced") & reached, F.col("component"))).alias("reduced_components_for_80pct"),
    )
