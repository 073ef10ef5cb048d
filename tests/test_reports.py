"""Reports over many classes, results per class, nested files, and copies in splits."""

import json

from pyspark.sql import functions as F

from tabscope.operators import evaluate, sampling
from tabscope.session import scratch_path
from tabscope.sources import sinks


def test_hundred_thousand_classes_without_a_grid(spark):
    df = spark.range(200000).select((F.col("id") % 100000).alias("y"), F.when(F.col("id") < 50000, F.col("id") + 1).otherwise(F.col("id") % 100000).alias("p"))
    counts = evaluate.confusion_counts(df, "y", "p")
    assert counts.count() == 150000
    report = evaluate.class_report(counts)
    assert report.count() == 100000
    row = report.where("class = 7").first()
    assert (row["support"], row["recall"], row["precision"]) == (2, 0.5, 0.5)
    metrics = {r["metric"]: r["value"] for r in evaluate.overall_metrics(counts).collect()}
    assert metrics["accuracy"] == 0.75


def test_sparse_counts_and_grid_give_one_report(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None), (None, "a"), ("c", "c"), ("c", "c")], "y string, p string")
    reports = [
        sorted(map(str, evaluate.class_report(f(df, "y", "p")).collect())) for f in (evaluate.confusion_counts, evaluate.confusion_matrix)
    ]
    assert reports[0] == reports[1]


def test_results_of_absent_classes(spark):
    test = spark.createDataFrame([("a", "a"), ("a", "x"), (None, "a")], "y string, p string")
    train = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "y string")
    expected = spark.createDataFrame([("a",), ("b",), ("z",)], "c string")
    found = {r["class"]: r for r in evaluate.class_results(test, train, "y", "p", expected).collect()}
    assert {c: (r["status"], r["support"], r["training_samples"]) for c, r in found.items()} == {
        "a": ("tested", 2, 1), "b": ("training_only", 0, 2), "z": ("missing", 0, 0), "x": ("predicted_only", 0, 0), None: ("tested", 1, 1),
    }
    assert found["a"]["recall"] == 0.5 and found["b"]["f1"] == 0.0

    path = scratch_path(spark, "classes")
    named = evaluate.class_results(test, train, "y", "p", expected).select(F.lit("s").alias("dataset"), F.lit("t").alias("task"), "*")
    sinks.write_class_json(named, path)
    (line,) = (json.loads(r["value"]) for r in spark.read.text(path).collect())
    assert line["dataset"] == "s" and line["classes"]["b"]["training_samples"] == 2 and set(line["classes"]) == {"a", "b", "x", "z", "null"}
    assert sinks.read_class_json(spark, path).where("class = 'a'").first()["precision"] == 0.5


def test_copies_of_a_topped_up_sample_stay_on_one_side(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") < 8, "rare").otherwise("common").alias("cls"))
    sample = sampling.stratified_sample(df, ["cls"], ["id"], 400, top_up="cls")
    assert sample.where("cls = 'rare'").count() > sample.where("cls = 'rare'").distinct().count()
    for split in (sampling.rare_aware_split(sample, "cls", ["id"]), sampling.stratified_split(sample, "cls", ["id"])):
        sides = split.groupBy("id").agg(F.count_distinct("split").alias("n"))
        assert sides.where("n > 1").isEmpty()
