import itertools
import json

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabscope.functions import scalars
from tabscope.operators import distances, encode, evaluate, models, sampling
from tabscope.operators.reduce import scaled_vectors
from tabscope.plans import flows
from tabscope.session import scratch_path
from tabscope.sources import sinks, tables


@pytest.fixture(scope="module")
def table(spark):
    """Flows of three classes that differ in two features; a constant, a copy and ports."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(420):
        cls = ("Audio", "DoS", "Mirai")[0 if i % 10 == 0 else 1 + i % 2]
        centre = {"Audio": (0, 0), "DoS": (4, 0), "Mirai": (0, 5)}[cls]
        x, y = rng.normal(centre[0], 0.4), rng.normal(centre[1], 0.4)
        rows.append((i, float(x), float(2 * x), float(y), 0.0, 80 + i % 3, 6 if i % 4 else 17,
                     "Benign" if cls == "Audio" else "Malicious", cls))
    schema = "id long, `Flow Bytes/s` double, twice double, y double, konst double, `Src Port` int, Protocol int, Label string, `Traffic Type` string"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def split(table):
    coded = encode.label_index(table, "Traffic Type", "c").withColumn("b", scalars.encode_label(F.col("Label")))
    vectors = scaled_vectors(coded, ["Flow Bytes/s", "y"], "features", keep=["id", "c", "b"])
    return sampling.stratified_split(vectors, "c", ["id"]).cache()


def metrics(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def test_svm_separates_classes(split):
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    binary = metrics(models.evaluate_svm(train, test, "b", "features", 2, 2, dimensions=64, iterations=15))
    assert binary["accuracy"] > 0.97 and binary["auc"] > 0.97 and binary["benign_f1"] > 0.9
    many = metrics(models.evaluate_svm(train, test, "c", "features", 3, 2, dimensions=64, iterations=10))
    assert many["accuracy"] > 0.95 and "auc" not in many


def test_perceptron_folds(split):
    summary = models.cross_validate_perceptron(
        split.where("split = 'train'"), "b", "features", ["id"], 2, 2, folds=2, iterations=15
    )
    found = {r["metric"]: (r["average"], r["std_dev"]) for r in summary.collect()}
    assert found["accuracy"][0] > 0.95 and {"loss", "auc", "generalization_gap", "train_accuracy"} <= set(found)


def test_kernel_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(6, 3))
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(points)], "i int, a array<double>")
    from pyspark.ml.functions import array_to_vector

    mapped = models.kernel_features(df.select("i", array_to_vector("a").alias("v")), "v", "k", 3, 4096, 0.3, 1)
    found = np.array([r[0] for r in mapped.orderBy("i").select(vector_to_array("k")).collect()])
    exact = np.exp(-0.3 * ((points[:, None] - points[None]) ** 2).sum(axis=2))
    assert np.abs(found @ found.T - exact).max() < 0.08


def test_balanced_copies(table):
    counts = {r[0]: r[1] for r in models.balanced_by_copies(table, "Traffic Type").groupBy("Traffic Type").count().collect()}
    assert max(counts.values()) / min(counts.values()) < 1.5


def test_scaling_fits_on_train_only(table):
    train = table.where("id < 100")
    scaled = encode.standard_scale(table, ["y", "konst"], fit_on=train)
    row = scaled.where("id < 100").agg(F.avg("y"), F.stddev_pop("y"), F.max("konst")).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0.0


def test_preprocessor_handles_unknown_categories(table):
    fitted = encode.Preprocessor(exclude=["id"]).fit(table.where("Protocol = 6"))
    names = [c._jc.toString() for c in fitted.columns()]
    assert len(names) == 6 + 7 + 1
    rows = fitted.transform(table, keep=["id", "Protocol"]).withColumn("last", vector_to_array("features")[13])
    assert {(r["Protocol"], r["last"]) for r in rows.collect()} == {(6, 1.0), (17, 0.0)}


def test_unseen_class_is_an_error(table):
    with pytest.raises(Exception, match="unseen class"):
        encode.label_index(table, "Traffic Type", classes=["DoS"]).collect()


def test_port_edges(spark):
    df = spark.createDataFrame([(p,) for p in (0, 1023, 1024, 49151, 49152, 65535, 70000, -1, None)], "p int")
    found = [r[0] for r in df.select(*scalars.port_category(F.col("p"), "p")).collect()]
    assert found == [0, 0, 1, 1, 2, 2, None, None, None]
    flags = df.where("p = 1024").select(*scalars.port_flags(F.col("p"), "p")).first()
    assert tuple(flags) == (0, 1, 0, 0, 0, 0, 0)


def test_auc_with_ties_equals_pair_count(spark):
    rows = [(1, 3.0), (0, 3.0), (1, 2.0), (0, 1.0), (0, 2.0), (1, 5.0), (0, 0.0)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    exact = sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))
    found = evaluate.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["auc"]
    assert found == pytest.approx(exact)


def test_report_with_zero_division(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("b", "b"), ("c", "c")], "y string, p string")
    confusion = evaluate.confusion_matrix(df, "y", "p")
    assert confusion.count() == 9
    report = {r["class"]: r for r in evaluate.class_report(confusion).collect()}
    assert (report["a"]["precision"], report["a"]["recall"], report["a"]["f1"]) == (0.0, 0.0, 0.0)
    assert report["b"]["precision"] == pytest.approx(1 / 3) and report["b"]["recall"] == 1.0
    overall = metrics(evaluate.overall_metrics(confusion))
    assert overall["accuracy"] == 0.5 and overall["macro_recall"] == pytest.approx(2 / 3)
    assert evaluate.f1_extremes(evaluate.class_report(confusion)).count() == 0
    assert evaluate.f1_extremes(evaluate.class_report(confusion), min_classes=3).count() == 6


@pytest.mark.parametrize("block", [3, 256])
def test_distances_against_numpy(spark, monkeypatch, block):
    monkeypatch.setattr(distances, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    points = rng.normal(size=(23, 3))
    points[5] = points[6]
    rows = [(i, int(i % 2), *map(float, p)) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    found = metrics(distances.neighbour_diagnosis(df, "y", ["id"], distances.feature_array(["a", "b", "c"])))
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    benign = d[::2][:, ::2] + np.diag([np.inf] * 12)
    across = d[::2][:, 1::2]
    assert found["benign_nearest_mean"] == pytest.approx(benign.min(axis=1).mean())
    assert found["benign_nearest_max"] == pytest.approx(benign.min(axis=1).max())
    assert found["cross_min"] == pytest.approx(across.min()) and found["cross_mean"] == pytest.approx(across.mean())


def test_distances_count_all_rows_of_both_sides(spark):
    rng = np.random.default_rng(6)
    points, y = rng.normal(size=(4400, 2)) ** 3, np.arange(4400) >= 2050
    rows = [(i, int(m), *map(float, p)) for i, (p, m) in enumerate(zip(points, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    found = metrics(distances.neighbour_diagnosis(df, "y", ["id"], distances.feature_array(["a", "b"])))
    apart = lambda a, b: np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    across = apart(points[~y], points[y])
    inside = apart(points[y], points[y]) + np.diag([np.inf] * int(y.sum()))
    assert found["cross_mean"] == pytest.approx(across.mean(), rel=1e-12) and found["cross_min"] == pytest.approx(across.min())
    assert found["malicious_nearest_mean"] == pytest.approx(inside.min(axis=1).mean())


@pytest.mark.parametrize("shift", [0.0, 1e7, 1e200])
def test_sum_of_distances_of_close_far_and_equal_rows(monkeypatch, shift):
    """Products of matrices lose close pairs of long vectors; rows with one id are no pair."""
    monkeypatch.setattr(distances, "CHUNK", 100)
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(20, 5)), rng.normal(size=(20, 5)) * 1e-6 + 3, np.full((3, 5), 3.0)]) + shift
    y = np.concatenate([x[5:30], rng.normal(size=(9, 5)) * 1e5])
    mine, other = np.arange(len(x)) % 30, np.arange(len(y)) + 12
    apart = mine[:, None] != other
    d = np.sqrt(((x[:, None] / 1e150 - y[None] / 1e150) ** 2).sum(axis=2)) * 1e150 if shift > 1e100 else np.sqrt(((x[:, None] - y[None]) ** 2).sum(axis=2))
    total, n = distances._sum_of_distances(x, y, mine, other)
    assert n == apart.sum() and 0 < n < apart.size
    assert total == (pytest.approx((d * apart).sum(), rel=1e-9) if shift < 1e100 else np.inf)


def test_mean_differences_with_sampled_side(table):
    coded = table.withColumn("b", scalars.encode_label(F.col("Label")))
    rows = evaluate.mean_differences(coded, ["y", "konst"], "b", malicious_rows=100, keys=["id"]).collect()
    assert [r["feature"] for r in rows] == ["y", "konst"] and rows[1]["difference"] == 0.0


def test_sources_and_sinks(spark, table):
    base = scratch_path(spark, "io")
    with pytest.raises(AnalysisException):
        tables.load_table(spark, f"{base}-missing")
    sinks.write_csv(table, f"{base}.csv")
    loaded = tables.load_table(spark, base)
    assert loaded.count() == 420 and loaded.columns == table.columns
    assert tables.load_table(spark, base).exceptAll(loaded).isEmpty()
    config = f"{base}-groups.json"
    spark.createDataFrame([('{"g": ["a", "b"], "h": ["c"]}',)], "value string").coalesce(1).write.text(config)
    assert {tuple(r) for r in tables.read_column_groups(spark, config).collect()} == {("g", "a"), ("g", "b"), ("h", "c")}
    metrics_ = spark.createDataFrame([("binary", "s", "accuracy", 0.5)], "task string, dataset string, metric string, value double")
    sinks.write_metrics_json(metrics_, f"{base}-m")
    line = json.loads(spark.read.text(f"{base}-m").first()[0])
    assert line == {"task": "binary", "dataset": "s", "metrics": {"accuracy": 0.5}}


def test_three_stages(spark, table):
    out = scratch_path(spark, "stages")
    long = flows.profile_table(table.drop("id"), f"{out}/profile")
    samples = flows.reduce_table(table, long, ["id"], f"{out}/reduce", sample_size=200, drop=["konst"], inits=1)
    assert {n: s.count() for n, s in samples.items()}.keys() == {"stratified", "kmeans", "density"}
    assert "konst" not in samples["stratified"].columns
    dropped = {r[0] for r in spark.read.text(f"{out}/reduce/dropped_features").collect()}
    assert len(dropped) == 1
    found = flows.classify_samples(
        {"stratified": samples["stratified"]}, ["id"], f"{out}/classify", iterations=5, folds=2
    )
    assert found.where("metric = 'accuracy'").count() == 4
    results = spark.read.option("header", True).csv(f"{out}/classify/binary_results").collect()
    assert [r["dataset"] for r in results] == ["stratified"]
    assert spark.read.json(f"{out}/classify/detailed_results").count() == 4
