import hashlib
import math

import pytest
from pyspark.sql import functions as F

from tabscope.operators import cluster_sampling, profile, quality, ranking, sampling


@pytest.fixture(scope="module")
def skewed(spark):
    """One stratum with most rows, a third in the next, and two rare ones."""
    classes = F.when(F.col("id") % 1000 == 0, "rare").when(F.col("id") == 7, "single").when(F.col("id") % 3 == 0, "third").otherwise("main")
    return spark.range(4000).select("id", classes.alias("cls"), (F.col("id") * 1.5).alias("x")).cache()


def order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}_{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("limit", [1_000_000, 100, 1])
def test_stratified_sample_is_exact_and_path_independent(skewed, limit):
    sample = sampling.stratified_sample(skewed, ["cls"], ["id"], 200, max_group_rows=limit)
    by = {}
    for r in skewed.collect():
        by.setdefault(r["cls"], []).append(r["id"])
    expected = set()
    for ids in by.values():
        quota = min(max(math.floor(len(ids) / 4000 * 200 + 0.5), 2), len(ids))
        expected |= set(order(ids, 42)[:quota])
    assert {r["id"] for r in sample.collect()} == expected


def test_sample_does_not_depend_on_partitions(spark, skewed):
    one = sampling.stratified_sample(skewed.repartition(1), ["cls"], ["id"], 100)
    many = sampling.stratified_sample(skewed.repartition(13), ["cls"], ["id"], 100)
    assert one.exceptAll(many).isEmpty() and one.count() == many.count()


@pytest.mark.parametrize("limit", [50])
def test_copies_are_counted_exactly(spark, limit):
    # A third of the rows are copies of one row.
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("v"))
    for n in (1, 449, 1000):
        assert sampling.simple_random_sample(rows, n, None, max_group_rows=limit).count() == min(n, 900)


def test_null_stratum_is_a_stratum(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id long, s string")
    found = sampling.stratified_sample(df, ["s"], ["id"], 10)
    assert {r["s"]: r["n"] for r in found.groupBy("s").agg(F.count("*").alias("n")).collect()} == {None: 5, "a": 5}


def test_presample(skewed):
    found = sampling.presample_large_groups(skewed, ["cls"], ["id"], large=1500, rows=100)
    counts = {r["cls"]: r["count"] for r in profile.category_counts(found, ["cls"]).collect()}
    before = {r["cls"]: r["count"] for r in profile.category_counts(skewed, ["cls"]).collect()}
    assert counts == {c: 100 if n > 1500 else n for c, n in before.items()}


@pytest.mark.parametrize("limit", [10])
def test_top_up_keeps_size_and_fills_classes(spark, skewed, limit):
    sample = sampling.stratified_sample(skewed, ["cls"], ["id"], 300)
    full = sampling.top_up_rare_classes(skewed, sample, "cls", ["id"], max_group_rows=limit)
    counts = {r["cls"]: r["count"] for r in profile.category_counts(full, ["cls"]).collect()}
    assert full.count() == sample.count()
    assert counts["rare"] == 30 and counts["single"] == 30


def test_top_up_without_rare_class_is_a_no_op(skewed):
    common = skewed.where("cls in ('main', 'third')")
    sample = sampling.stratified_sample(common, ["cls"], ["id"], 200)
    assert sampling.top_up_rare_classes(common, sample, "cls", ["id"]).exceptAll(sample).isEmpty()


def test_top_up_with_small_majority_returns_sample(spark):
    df = spark.createDataFrame([(i, "a" if i < 12 else "b") for i in range(20)], "id long, cls string")
    assert sampling.top_up_rare_classes(df, df, "cls", ["id"]).exceptAll(df).isEmpty()


def test_top_up_without_keys(spark):
    df = spark.createDataFrame([("a",)] * 200 + [("b",)] * 3, "cls string")
    full = sampling.stratified_sample(df, ["cls"], None, 100, top_up="cls")
    assert {r["cls"]: r["count"] for r in profile.category_counts(full, ["cls"]).collect()}["b"] == 30
    assert full.count() == 101


def test_rare_aware_split(spark):
    rows = [(i, "common") for i in range(20)] + [(20, "pair"), (21, "pair"), (22, "single")]
    df = spark.createDataFrame(rows, "id long, cls string")
    found = {}
    for r in sampling.rare_aware_split(df, "cls", ["id"]).collect():
        found.setdefault((r["cls"], r["split"]), []).append(r["id"])
    assert {k: len(v) for k, v in found.items()} == {
        ("common", "train"): 15, ("common", "test"): 5, ("pair", "train"): 1, ("pair", "test"): 1, ("single", "train"): 1,
    }


def test_split_sizes_by_largest_remainder(spark):
    # Three classes of 10: 8 of 30 rows test, so one class gives 2 and the others 3.
    df = spark.range(30).select("id", (F.col("id") % 3).alias("cls"))
    found = sampling.stratified_split(df, "cls", ["id"]).where("split = 'test'").groupBy("cls").count().collect()
    assert sorted(r["count"] for r in found) == [2, 3, 3]


@pytest.mark.parametrize("limit", [1_000_000, 40])
def test_folds_are_disjoint_and_balanced(skewed, limit):
    folds = sampling.stratified_folds(skewed, "cls", ["id"], max_group_rows=limit)
    assert folds.count() == 4000
    sizes = {}
    for r in folds.groupBy("cls", "fold").count().collect():
        sizes.setdefault(r["cls"], {})[r["fold"]] = r["count"]
    for counts in sizes.values():
        full = [counts.get(f, 0) for f in range(5)]
        assert max(full) - min(full) <= 1


def test_random_split_is_exact(skewed):
    counts = {r["split"]: r["count"] for r in sampling.random_split(skewed, ["id"], max_group_rows=64).groupBy("split").count().collect()}
    assert counts == {"train": 3600, "test": 400}


def test_shuffle_keeps_rows(skewed):
    assert ranking.shuffle_rows(skewed, ["id"], 1).exceptAll(skewed).isEmpty()


def test_quality_of_published_percentages(spark):
    """Two classes at 0/100 percent before and 1.2/98.8 after: similarity 98.8."""
    before = spark.createDataFrame([("Malicious",)] * 1000, "Label string")
    after = spark.createDataFrame([("Malicious",)] * 988 + [("Benign",)] * 12, "Label string")
    row = quality.overall_quality(before, after, ["Label"]).first()
    assert row["overall_quality"] == 98.8 and row["size_reduction"] == 0.0
    lines = [r["value"] for r in quality.quality_report(before, after, ["Label"]).collect()]
    assert lines[0] == "Label: distribution similarity 98.80%" and len(lines) == 4


def test_quality_of_empty_sample(spark):
    before = spark.createDataFrame([("a",)] * 3, "c string")
    row = quality.overall_quality(before, before.limit(0), ["c"]).first()
    assert row["overall_quality"] == 0.0 and row["size_reduction"] == 100.0


@pytest.fixture(scope="module")
def blobs(spark):
    """Two tight blobs and scattered noise in each of two strata."""
    def point(i):
        s, j = ("p", "q")[i % 2], i // 2
        if j < 60:
            return (i, s, (j % 8) * 0.01, (j % 7) * 0.01)
        if j < 120:
            return (i, s, 10 + (j % 8) * 0.01, 10 + (j % 7) * 0.01)
        return (i, s, (j * 37 % 101) / 10.0, 20 + (j * 53 % 97) / 10.0)

    return spark.createDataFrame([point(i) for i in range(260)], "id long, s string, x double, y double").cache()


def test_kmeans_sample_takes_medoids(blobs):
    sample = cluster_sampling.kmeans_sample(blobs.where("id < 240"), ["s"], ["x", "y"], ["id"], 4, inits=3)
    rows = sample.collect()
    assert {(r["s"], r["x"] > 5) for r in rows} == {("p", False), ("p", True), ("q", False), ("q", True)}
    assert len(rows) == 4


def test_kmeans_sample_of_one_per_stratum(blobs):
    assert cluster_sampling.kmeans_sample(blobs, ["s"], ["x", "y"], ["id"], 2, inits=1).count() == 2


def test_density_clusters_find_the_blobs(blobs):
    scored = cluster_sampling.scaled_in_stratum(blobs, ["s"], ["x", "y"])
    rows = cluster_sampling.density_clusters(scored, ["s"], ["id"]).join(blobs.select("id", "x", "y"), "id").collect()
    for s in ("p", "q"):
        first = {r["cluster"] for r in rows if r["s"] == s and r["y"] < 5}
        second = {r["cluster"] for r in rows if r["s"] == s and 5 < r["y"] < 15}
        assert len(first) == 1 and len(second) == 1 and None not in first | second and first != second


def test_density_sample_fills_targets(blobs):
    counts = cluster_sampling.density_sample(blobs, ["s"], ["x", "y"], ["id"], 60).groupBy("s").count().collect()
    assert {r["s"]: r["count"] for r in counts} == {"p": 30, "q": 30}


def test_density_quotas(spark):
    rows = [("s", "a")] * 50 + [("s", "b")] * 30 + [("s", None)] * 20
    clusters = spark.createDataFrame(rows, "s string, cluster string")
    targets = spark.createDataFrame([("s", 10)], "s string, target long")
    found = {r["cluster"]: r["quota"] for r in cluster_sampling.density_quotas(clusters, targets, ["s"]).collect()}
    assert found == {"a": 5, "b": 3, None: 2}
