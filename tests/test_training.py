"""Training by full gradients, and codes for very many categories."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabscope.operators import columns, encode, models, training


@pytest.fixture(scope="module")
def rings(spark):
    """Three classes on rings, of very different sizes: no straight line tells them apart."""
    rng = np.random.default_rng(6)
    rows = []
    for i in range(900):
        y = 0 if i % 30 == 0 else 1 + i % 2
        angle, radius = rng.uniform(0, 2 * np.pi), (0.4, 1.5, 3.0)[y] + rng.normal(0, 0.1)
        rows.append((i, y, [float(radius * np.cos(angle)), float(radius * np.sin(angle))]))
    df = spark.createDataFrame(rows, "id long, y int, x array<double>")
    return df.select("id", "y", array_to_vector("x").alias("v")).cache()


def slopes(model, p, x, y, w):
    step = 1e-6
    return [(model.loss(p + step * e, x, y, w)[0] - model.loss(p - step * e, x, y, w)[0]) / (2 * step) for e in np.eye(len(p))]


@pytest.mark.parametrize("model", [
    training.Perceptron([3, 4, 2, 3]), training.KernelSvm(3, 6, 3, 0.5, 0.1, 1), training.KernelSvm(3, 6, 2, 0.5, 0.1, 1),
])
def test_gradients_match_differences(model):
    rng = np.random.default_rng(1)
    p = rng.normal(size=len(model.start(1) if isinstance(model, training.Perceptron) else model.start()))
    x, y, w = rng.normal(size=(20, 3)), rng.integers(0, 2, 20), rng.uniform(0.5, 2, 20)
    assert model.loss(p, x, y, w)[1] == pytest.approx(slopes(model, p, x, y, w), abs=1e-4)


def test_sums_over_tasks_and_folds(spark, rings):
    rows = rings.select(vector_to_array("v").alias("x"), F.col("y").cast("long").alias("y"), (F.col("id") % 3 + 1).cast("double").alias("w"), (F.col("id") % 4).cast("int").alias("fold")).repartition(11)
    model = training.Perceptron([2, 5, 3])
    p = np.stack([model.start(1), model.start(2)])
    local = rows.toPandas()
    x = np.stack(local["x"].to_numpy())
    for few in (False, True):
        loss, gradient = training.gradient_sums(rows, model, p, [2, -1], few)
        for k, seen in enumerate((local["fold"] != 2, local["fold"] >= 0)):
            want = model.loss(p[k], x[seen], local["y"].to_numpy()[seen], local["w"].to_numpy()[seen])
            total = local["w"][seen].sum()
            assert loss[k] == pytest.approx(want[0] / total) and gradient[k] == pytest.approx(want[1] / total)


def test_the_driver_gets_one_gradient_whatever_the_tasks(monkeypatch, spark, rings):
    rows = rings.select(vector_to_array("v").alias("x"), F.col("y").cast("long").alias("y"), F.lit(1.0).alias("w"), F.lit(0).alias("fold"))
    model = training.Perceptron([2, 5, 3])
    sent, collect = [], type(rows).collect
    monkeypatch.setattr(type(rows), "collect", lambda self: sent.append(collect(self)) or sent[-1])
    for tasks, few in ((1, True), (30, True), (130, False)):
        training.gradient_sums(rows.repartition(tasks), model, np.stack([model.start(1), model.start(2)]), [-1, 1], few)
    assert [len(found) for found in sent] == [2, 2, 2]


def test_weights_equal_copies(spark, rings):
    weighted = rings.withColumn("w", F.when(F.col("y") == 0, 14.0).otherwise(1.0))
    copied = weighted.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("w").cast("int")))).withColumn("w", F.lit(1.0))
    scored = []
    for train in (weighted, copied):
        score = models.fit_perceptrons(train, "y", "v", 3, 2, iterations=12, hidden=(6, 4), weight="w")
        rows = score(rings).orderBy("id").select(vector_to_array("probability")).collect()
        scored.append(np.array([r[0] for r in rows]))
    assert np.abs(scored[0] - scored[1]).max() < 1e-6


def test_networks_and_machines_learn_rings(rings):
    train, test = rings.where("id % 4 > 0"), rings.where("id % 4 = 0")
    for table in (
        models.evaluate_perceptron(train, test, "y", "v", 3, 2, iterations=60),
        models.evaluate_svm(train, test, "y", "v", 3, 2, dimensions=128),
    ):
        found = {r["metric"]: r["value"] for r in table.collect()}
        assert found["accuracy"] > 0.97 and found["macro_recall"] > 0.95


def test_all_classes_take_the_passes_of_one(monkeypatch, rings):
    passes = []
    sums = training.gradient_sums
    monkeypatch.setattr(models, "gradient_sums", lambda *a: passes.append(1) or sums(*a))
    models.fit_svm(rings, "y", "v", 3, 2, dimensions=32, iterations=8)
    three = len(passes)
    models.fit_svm(rings.withColumn("y", F.col("id").cast("int") % 10), "y", "v", 10, 2, dimensions=32, iterations=8)
    assert len(passes) - three <= 2 * three


def test_minimise_settles_side_by_side():
    def bowls(p):
        scale = np.array([1.0, 10.0, 100.0])
        return ((p - 3) ** 2 * scale[:, None]).sum(1), 2 * (p - 3) * scale[:, None]

    assert training.minimise(bowls, np.zeros((3, 4)), 50) == pytest.approx(np.full((3, 4), 3.0), abs=1e-3)


def test_hundred_thousand_categories(spark):
    df = spark.range(200000).select("id", F.concat(F.lit("c"), F.col("id") % 100000).alias("kind"), (F.col("id") % 7).cast("double").alias("x"))
    known = df.where("kind <> 'c5'")
    fitted = encode.Preprocessor(ordinal_columns=["kind"], one_hot_columns=["kind"], port_columns=[], exclude=["id"]).fit(known)
    out = fitted.transform(df, keep=["id"]).withColumn("v", F.col("features"))
    names = sorted(f"c{k}" for k in range(100000) if k != 5)
    for r in out.where("id IN (5, 100005, 77, 123456)").collect():
        name = f"c{r['id'] % 100000}"
        hot = [int(i) for i in r["features"].indices if i > 1]
        assert r["features"].size == 2 + len(names)
        assert r["features"][1] == (names.index(name) if name in names else -1)
        assert hot == ([2 + names.index(name)] if name in names else [])
    codes = columns.dictionary(known, "kind")
    assert encode.ordinal_encode(df, "kind", codes).where("code = -1").count() == 2
