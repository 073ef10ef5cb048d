"""How strongly each feature goes with a binary label: correlation, tests and effect size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.scalars import col
from tabscope.functions.tdist import t_pvalue
from tabscope.operators.profile import to_long

# Fixed values.
MIN_VALID_ROWS = 10
TOP_FEATURES = 15
STRONG = 0.3
MODERATE = 0.1
SIGNIFICANT = 0.05


def label_moments(
    df: DataFrame, features: Sequence[str], label: str, negative: str | int, positive: str | int
) -> DataFrame:
    """Counts, means and sample variances of each feature on both sides of the label.

    One partial aggregate over (feature, value) rows whose feature and label are present. Features with
    fewer than 10 such rows, or none on one side, are left out.
    """
    side = F.when(col(label) == negative, 0).when(col(label) == positive, 1)
    long = to_long(df.withColumn("_side", side), features, ["_side"])
    valid = long.where(F.col("value").isNotNull() & F.col("_side").isNotNull())

    def on(s: int) -> Column:
        return F.when(F.col("_side") == s, F.col("value"))

    moments = valid.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(on(0)).alias("n0"), F.count(on(1)).alias("n1"),
        F.avg(on(0)).alias("mean0"), F.avg(on(1)).alias("mean1"),
        F.var_samp(on(0)).alias("var0"), F.var_samp(on(1)).alias("var1"),
        F.var_pop(on(0)).alias("pop_var0"), F.var_pop(on(1)).alias("pop_var1"),
        F.stddev_pop("value").alias("pop_std"),
    )
    return moments.where((F.col("n") >= MIN_VALID_ROWS) & (F.col("n0") > 0) & (F.col("n1") > 0))


def _over(numerator: Column, denominator: Column) -> Column:
    """The quotient; infinite where only the denominator is 0, null for 0 / 0."""
    infinite = F.when(numerator != 0, F.signum(numerator) * F.lit(float("inf")))
    return F.when(denominator == 0, infinite).otherwise(numerator / denominator)


def feature_label_association(
    df: DataFrame, features: Sequence[str], label: str, negative: str | int = "Benign",
    positive: str | int = "Malicious", pvalues: bool = True,
) -> DataFrame:
    """One row per feature, strongest correlation first.

    Point-biserial r, difference of means, Cohen's d, and the means, population deviations and counts of
    both sides; with ``pvalues`` also the p-values of r and of Welch's t-test.
    """
    c = {n: F.col(n) for n in ("n", "n0", "n1", "mean0", "mean1", "var0", "var1", "pop_var0", "pop_var1", "pop_std")}
    gap = F.abs(c["mean0"] - c["mean1"])
    r = F.try_divide((c["mean1"] - c["mean0"]) * F.sqrt(c["n0"] * c["n1"]), c["n"] * c["pop_std"])
    pooled = F.sqrt(
        F.try_divide((c["n0"] - 1) * c["pop_var0"] + (c["n1"] - 1) * c["pop_var1"], c["n0"] + c["n1"] - 2)
    )
    error0, error1 = c["var0"] / c["n0"], c["var1"] / c["n1"]
    welch_t = _over(c["mean0"] - c["mean1"], F.sqrt(error0 + error1))
    # Two constant sides have no spread to take degrees of freedom from; any number gives their infinite t p = 0.
    welch_df = F.when(error0 + error1 == 0, (c["n"] - 2).cast("double")).otherwise(F.try_divide(
        F.pow(error0 + error1, F.lit(2)),
        F.try_divide(F.pow(error0, F.lit(2)), c["n0"] - 1) + F.try_divide(F.pow(error1, F.lit(2)), c["n1"] - 1),
    ))
    # r may pass 1 by rounding; what is left below 1e-15 is none.
    rest = 1 - F.pow("_r", F.lit(2))
    corr_t = _over(F.col("_r") * F.sqrt(c["n"] - 2), F.sqrt(F.when(rest > 1e-15, rest).otherwise(0.0)))
    moments = label_moments(df, features, label, negative, positive).withColumn("_r", r)
    result = moments.select(
        "feature",
        F.round("_r", 4).alias("point_biserial_corr"),
        *([
            F.round(t_pvalue(corr_t, (c["n"] - 2).cast("double")), 6).alias("corr_p_value"),
            F.round(t_pvalue(welch_t, welch_df), 6).alias("t_test_p_value"),
        ] if pvalues else []),
        F.round(gap, 4).alias("mean_diff"),
        F.round(F.when(pooled > 0, gap / pooled).otherwise(0.0), 4).alias("cohens_d"),
        F.round("mean0", 4).alias("benign_mean"), F.round("mean1", 4).alias("malicious_mean"),
        F.round(F.sqrt("pop_var0"), 4).alias("benign_std"), F.round(F.sqrt("pop_var1"), 4).alias("malicious_std"),
        F.col("n0").alias("benign_count"), F.col("n1").alias("malicious_count"),
    )
    return result.orderBy(F.abs("point_biserial_corr").desc_nulls_last(), "feature")


def top_features(association: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """The ``n`` features with the largest |r|; ties by name."""
    return association.orderBy(F.abs("point_biserial_corr").desc_nulls_last(), "feature").limit(n)


def significance_stars(p: Column) -> Column:
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < SIGNIFICANT, "*").otherwise("")


def importance_table(association: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    """(feature, point_biserial_corr, stars) of the strongest features."""
    return top_features(association, n).select(
        "feature", "point_biserial_corr", significance_stars(F.col("corr_p_value")).alias("stars")
    )


def association_summary(association: DataFrame) -> DataFrame:
    """One row: how many features are analyzed, strong, moderate and significant."""
    r = F.abs("point_biserial_corr")
    return association.agg(
        F.count(F.lit(1)).alias("analyzed"),
        F.count_if(r > STRONG).alias("strong"),
        F.count_if((r > MODERATE) & (r <= STRONG)).alias("moderate"),
        F.count_if(F.col("corr_p_value") < SIGNIFICANT).alias("significant"),
    )
