"""Pearson correlation between columns, between their statistics, and what follows from it.

Wide matrices go through one vector column and ``ml.stat.Correlation``: one pass whose partial results are
d x d sums per task, against thousands of separate aggregates for the SQL form. The result is a long table
(feature1, feature2, r) with the positions of both features; its size depends on the width alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.aggregates import safe_corr
from tabscope.functions.scalars import col, encode_label
from tabscope.operators.columns import dictionary, dictionary_encode, drop_columns, numeric_columns
from tabscope.operators.neighbours import matrix
from tabscope.operators.profile import to_long, variances
from tabscope.session import checkpoint, ship

# Fixed values.
HIGH_CORRELATION = 0.7
STRONG_CORRELATION = 0.8
CLUSTER_CORRELATION = 0.9
LABEL_CORRELATION = 0.15
TOP_PAIRS = 20
MIN_REDUCED_FEATURES = 5
STATISTICS = ("mean", "std", "min", "p25", "p50", "p75", "max")
DESCRIBE_ROWS = ("count", "null_count", "mean", "std", "min", "p25", "p50", "p75", "max")
AGGREGATES = ("mean", "std", "min", "max")

# Columns of a tile, and products that a task holds before it passes them on.
TILE = 256
PRODUCTS_HELD = 1 << 22

LONG_SCHEMA = "position1 int, position2 int, feature1 string, feature2 string, r double"


def varying_columns(df: DataFrame, features: Sequence[str], rule: str = "near_zero") -> list[str]:
    """The features that are not constant by the named rule of ``variances``."""
    constant = {r["feature"] for r in variances(df, features).where(col(rule)).select("feature").collect()}
    return [f for f in features if f not in constant]


def correlation_long(
    df: DataFrame, features: Sequence[str], rule: str = "near_zero", missing: str = "skip"
) -> DataFrame:
    """All ordered pairs of the varying features with their Pearson r, the diagonal included.

    ``missing``: ``skip`` leaves out rows in which any feature is null or NaN, ``zero`` reads them as 0. Without a
    complete row, and for a feature that is constant in the complete rows, r is null.
    """
    spark = df.sparkSession
    kept = varying_columns(df, features, rule)
    if not kept:
        return spark.createDataFrame([], LONG_SCHEMA)
    # VectorAssembler splits names at dots; numbered columns avoid that.
    numbered = df.select(*[col(c).cast("double").alias(f"c{i}") for i, c in enumerate(kept)])
    if missing == "zero":
        numbered = numbered.fillna(0.0)
    names = [f"c{i}" for i in range(len(kept))]
    complete = numbered.dropna()
    ends = complete.agg(F.count(F.lit(1)), *[f(n) for n in names for f in (F.min, F.max)]).first()
    # Columns can turn constant once rows with gaps are left out; their r is undefined, that with themselves too.
    varying = [i for i in range(len(kept)) if ends[0] and ends[1 + 2 * i] != ends[2 + 2 * i]]
    found = {}
    if varying:
        vectors = VectorAssembler(inputCols=[names[i] for i in varying], outputCol="v", handleInvalid="keep")
        matrix = Correlation.corr(vectors.transform(complete).select("v"), "v", "pearson").first()[0].toArray()
        found = {(i, j): float(matrix[p, q]) for p, i in enumerate(varying) for q, j in enumerate(varying)}
    rows = [(i, j, a, b, found.get((i, j))) for i, a in enumerate(kept) for j, b in enumerate(kept)]
    return spark.createDataFrame(rows, LONG_SCHEMA)


def prepare_with_targets(
    df: DataFrame, label: str, class_column: str, benign: str, positive_first: bool = True
) -> tuple[DataFrame, list[str]]:
    """Label as 0/1, class as its rank in sorted order, and the feature order: label, then table order."""
    coded = dictionary_encode(df, class_column, dictionary(df, class_column), out="_class")
    names = [c for c in df.columns if c in {label, class_column} or c in set(numeric_columns(df))]
    replaced = {label: encode_label(col(label), benign), class_column: F.col("_class")}
    prepared = coded.select(*[(replaced[c] if c in replaced else col(c)).alias(c) for c in names])
    ordered = [label] + [c for c in names if c != label] if positive_first else names
    return prepared, ordered


def feature_correlations(df: DataFrame, label: str, class_column: str, benign: str = "Benign") -> DataFrame:
    """Long matrix over the encoded label and class and all varying numeric columns."""
    prepared, ordered = prepare_with_targets(df, label, class_column, benign)
    return correlation_long(prepared, ordered, "near_zero")


def numeric_correlations(df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
    """Long matrix over the numeric columns alone, without ``drop`` and without exactly constant ones."""
    rest = drop_columns(df, drop)
    return correlation_long(rest, numeric_columns(rest), "zero")


def correlation_matrix(long: DataFrame) -> DataFrame:
    """Square form for a CSV: one row and one column per feature, in feature order."""
    order = [r["feature1"] for r in long.select("position1", "feature1").distinct().orderBy("position1").collect()]
    square = long.groupBy("position1", F.col("feature1").alias("feature")).pivot("feature2", order).agg(F.first("r"))
    return square.orderBy("position1").drop("position1")


def high_correlation_pairs(long: DataFrame, threshold: float = HIGH_CORRELATION) -> DataFrame:
    """Each pair with |r| above the threshold once, in feature order, r at six decimals."""
    return long.where((F.col("position1") < F.col("position2")) & (F.abs("r") > threshold)).select(
        "feature1", "feature2", F.round("r", 6).alias("correlation")
    )


def top_pairs(
    long: DataFrame, sign: int, threshold: float = STRONG_CORRELATION, n: int = TOP_PAIRS
) -> DataFrame:
    """The ``n`` strongest positive (sign 1) or negative (sign -1) pairs beyond the threshold."""
    strength = F.col("r") * sign
    return (
        long.where((F.col("position1") < F.col("position2")) & (strength > threshold))
        .orderBy(strength.desc(), "position1", "position2")
        .limit(n)
        .select("feature1", "feature2", "r")
    )


def greedy_clusters(long: DataFrame, threshold: float = CLUSTER_CORRELATION) -> DataFrame:
    """(cluster, position, feature): a feature not yet taken gathers all features with |r| above the threshold.

    Taken features can be gathered again, so clusters may overlap. The pass depends on feature order; it
    walks the edges of the feature graph, which are bounded by the width of the table.
    """
    edges = long.where((F.col("position1") != F.col("position2")) & (F.abs("r") > threshold))
    near = edges.groupBy("position1", "feature1").agg(
        F.array_sort(F.collect_list(F.struct("position2", "feature2"))).alias("near")
    )
    taken: set[str] = set()
    rows: list[tuple[int, int, str]] = []
    cluster = 0
    for r in near.orderBy("position1").collect():
        if r["feature1"] in taken:
            continue
        members = [r["feature1"], *[m["feature2"] for m in r["near"]]]
        rows += [(cluster, i, m) for i, m in enumerate(members)]
        taken.update(members)
        cluster += 1
    return long.sparkSession.createDataFrame(rows, "cluster int, position int, feature string")


def reduced_matrix(
    long: DataFrame, clusters: DataFrame, min_features: int = MIN_REDUCED_FEATURES
) -> DataFrame:
    """The long matrix among cluster heads and unclustered features.

    Empty unless that leaves fewer features than before and more than ``min_features``.
    """
    heads = clusters.where(F.col("position") == 0).select("feature").distinct()
    features = long.select(F.col("feature1").alias("feature")).distinct()
    alone = features.join(clusters.select("feature"), "feature", "left_anti")
    kept = heads.unionByName(alone).distinct()
    before = features.select(F.count(F.lit(1))).scalar()
    after = kept.select(F.count(F.lit(1))).scalar()
    result = long.join(kept.select(F.col("feature").alias("feature1")), "feature1", "left_semi")
    result = result.join(kept.select(F.col("feature").alias("feature2")), "feature2", "left_semi")
    return result.where((after < before) & (after > min_features)).select(*long.columns)


def significant_for_label(long: DataFrame, label: str, threshold: float = LABEL_CORRELATION) -> DataFrame:
    """Features whose |r| with the label exceeds the threshold."""
    return long.where(
        (F.col("feature1") == label) & (F.col("feature2") != label) & (F.abs("r") > threshold)
    ).select(F.col("feature2").alias("feature"), "r")


def _statistic_rows(described: DataFrame, names: Sequence[str]) -> DataFrame:
    """(feature, statistic, value) of the numeric features of a describe result."""
    numeric = described.where(F.col("mean").isNotNull())
    wide = numeric.select("feature", *[F.col(n).cast("double").alias(n) for n in names])
    return wide.unpivot(["feature"], list(names), "statistic", "value")


def _pairwise(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of every two statistics over the features; undefined ones stay null."""
    keys = [*by, "feature"]
    other = rows.select(*keys, F.col("statistic").alias("statistic2"), F.col("value").alias("value2"))
    pairs = rows.join(other, keys).where(F.col("value").isNotNull() & F.col("value2").isNotNull())
    return pairs.groupBy(*by, F.col("statistic").alias("statistic1"), "statistic2").agg(
        safe_corr(F.col("value"), F.col("value2")).alias("r")
    )


def statistic_correlation(described: DataFrame) -> DataFrame:
    """7x7 correlation between the statistics of the features, across features."""
    return _pairwise(_statistic_rows(described, STATISTICS))


def statistic_correlation_by_group(
    described: DataFrame, groups: DataFrame, label: str = "Label"
) -> DataFrame:
    """The same within named groups (group, feature); groups with fewer than two known features are skipped."""
    rows = _statistic_rows(described, STATISTICS)
    members = groups.where(F.col("feature") != label).join(rows.select("feature").distinct(), "feature")
    sizes = members.groupBy("group").agg(F.countDistinct("feature").alias("n")).where(F.col("n") >= 2)
    chosen = members.join(sizes.select("group"), "group", "left_semi")
    return _pairwise(rows.join(chosen, "feature"), ["group"])


def aggregate_statistic_correlation(described: DataFrame) -> DataFrame:
    """Correlation between mean, std, min and max taken over each feature's nine describe rows.

    The count of describe rows is the same for all features, so its correlations are undefined and left out.
    """
    summary = (
        _statistic_rows(described, DESCRIBE_ROWS)
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max"),
        )
    )
    return _pairwise(summary.unpivot(["feature"], list(AGGREGATES), "statistic", "value"))


def group_products(df: DataFrame, members: dict[int, list[str]], centres: dict[str, float]) -> DataFrame:
    """(g, i, j, total): for each group, sums over its complete rows of the products of its columns i <= j, less their centres.

    One column more than a group has, the last, is 1, so its products are the sums and the number of rows. Products are made in
    tiles of ``TILE`` x ``TILE`` columns within a group and passed on as soon as a task holds ``PRODUCTS_HELD`` of them, so neither a
    task nor the driver holds a whole matrix, and the work follows the squares of the groups' sizes.
    """
    ship(df.sparkSession)
    names = list(dict.fromkeys(c for columns in members.values() for c in columns))
    place = {g: [names.index(c) for c in columns] for g, columns in members.items()}
    middle = np.array([centres.get(c) or 0.0 for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], np.ndarray] = {}
        size = 0
        for batch in batches:
            x = matrix(batch.column("x")) - middle if batch.num_rows else np.zeros((0, len(names)))
            for g, columns in place.items():
                part = x[:, columns]
                part = np.column_stack([part, np.ones(len(part))])[~np.isnan(part).any(1)]
                for a in range(0, part.shape[1], TILE):
                    for b in range(a, part.shape[1], TILE):
                        products = part[:, a : a + TILE].T @ part[:, b : b + TILE]
                        if (g, a, b) in held:
                            held[g, a, b] += products
                        else:
                            held[g, a, b] = products
                            size += products.size
                    if size > PRODUCTS_HELD:
                        yield from _products(held)
                        held, size = {}, 0
        yield from _products(held)

    rows = df.select(F.array(*[F.nanvl(col(c).cast("double"), F.lit(None)) for c in names]).alias("x"))
    sums = rows.mapInArrow(run, "g int, i int, j int, total double")
    return sums.groupBy("g", "i", "j").agg(F.sum("total").alias("total"))


def _products(held: dict[tuple[int, int, int], np.ndarray]) -> Iterator[pa.RecordBatch]:
    for (g, a, b), products in held.items():
        i, j = (x.ravel() for x in np.indices(products.shape))
        upper = np.flatnonzero(a + i <= b + j)
        ids = [np.full(len(upper), g), a + i[upper], b + j[upper]]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int32)) for c in ids] + [pa.array(products.ravel()[upper])], ["g", "i", "j", "total"])


def group_correlation(df: DataFrame, groups: DataFrame) -> DataFrame:
    """(group, feature1, feature2, r): Pearson r between the numeric columns of each named group, both orders and the diagonal.

    Constant columns are left out; rows with a gap in a group do not count for it. Only what groups ask for is computed, in one
    pass (``group_products``). Without complete rows, and for columns that are constant in them, r is null.
    """
    spark = df.sparkSession
    asked = sorted({(r["group"], r["feature"]) for r in groups.select("group", "feature").distinct().collect()})
    numeric = numeric_columns(df)
    wanted = {f for _, f in asked}
    varying = set(varying_columns(df, [c for c in numeric if c in wanted], "zero"))
    named = dict(enumerate(dict.fromkeys(g for g, _ in asked)))
    members = {k: [c for c in numeric if c in varying and (g, c) in set(asked)] for k, g in named.items()}
    members = {k: columns for k, columns in members.items() if columns}
    if not members:
        return spark.createDataFrame([], "group string, feature1 string, feature2 string, r double")
    means = to_long(df, sorted(varying)).where(~F.isnan("value")).groupBy("feature").agg(F.avg("value").alias("m"))
    sums = checkpoint(group_products(df, members, {r["feature"]: r["m"] for r in means.collect()}))
    last = F.element_at(F.lit([len(members.get(k, ())) for k in named]), F.col("g") + 1)
    rows = sums.where((F.col("i") == last) & (F.col("j") == last)).select("g", F.col("total").alias("n"))
    ones = sums.where((F.col("j") == last) & (F.col("i") < last)).select("g", "i", F.col("total").alias("s"))
    own = sums.where((F.col("i") == F.col("j")) & (F.col("i") < last)).select("g", "i", F.col("total").alias("q"))
    spread = ones.join(own, ["g", "i"]).join(rows, "g").withColumn("var", F.try_divide("q", "n") - F.pow(F.try_divide("s", "n"), F.lit(2)))
    # What is left of a constant by rounding is no variance.
    spread = spread.withColumn("var", F.when(F.col("var") > 1e-12 * F.col("q") / F.col("n"), F.col("var")))
    labels = spark.createDataFrame([(k, i, named[k], c) for k, columns in members.items() for i, c in enumerate(columns)], "g int, i int, group string, feature string")
    spread = checkpoint(spread.join(labels, ["g", "i"]))
    pairs = sums.where(F.col("j") < last)
    pairs = pairs.unionByName(pairs.where("i < j").select("g", F.col("j").alias("i"), F.col("i").alias("j"), "total"))
    one = spread.select("g", "i", "group", F.col("feature").alias("feature1"), F.col("s").alias("s1"), F.col("var").alias("v1"), "n")
    two = spread.select("g", F.col("i").alias("j"), F.col("feature").alias("feature2"), F.col("s").alias("s2"), F.col("var").alias("v2"))
    joined = pairs.join(one, ["g", "i"]).join(two, ["g", "j"])
    covariance = F.try_divide("total", "n") - F.try_divide("s1", "n") * F.try_divide("s2", "n")
    r = F.try_divide(covariance, F.sqrt(F.col("v1") * F.col("v2")))
    return joined.select("group", "feature1", "feature2", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)).alias("r"))
