"""Classifiers trained by full gradients: kernel support vector machines and multilayer perceptrons."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.functions.aggregates import join_on, small
from tabscope.functions.scalars import col
from tabscope.operators.evaluate import (
    confusion_counts,
    fold_summary,
    generalization_gap,
    class_report,
    overall_metrics,
)
from tabscope.operators.profile import class_weights
from tabscope.operators.sampling import stratified_folds
from tabscope.operators.training import KernelSvm, Perceptron, few_tasks, gradient_sums, minimise
from tabscope.session import checkpoint, ship, written

# Fixed values.
SVM_C = 10.0
HIDDEN_LAYERS = (128, 64, 32)


def kernel_features(
    df: DataFrame, vector: str, out: str, size: int, dimensions: int, gamma: float, seed: int
) -> DataFrame:
    """Random Fourier features of the RBF kernel (``KernelSvm``) as a column."""
    model = KernelSvm(size, dimensions, 2, gamma, 0.0, seed)
    ship(df.sparkSession)

    @F.pandas_udf("array<double>")
    def project(batch: pd.Series) -> pd.Series:
        return pd.Series(list(model.features(np.stack(batch.to_numpy()))))

    return df.withColumn(out, array_to_vector(project(vector_to_array(vector))))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Add the balanced class weight of each row; the weights come from one row per class."""
    weights = checkpoint(class_weights(df, label).select(col(label), F.col("weight").alias(out)))
    return join_on(df, small(weights), [label])


def balanced_by_copies(df: DataFrame, label: str) -> DataFrame:
    """Repeat the rows of the smaller classes so that all classes weigh about the same.

    For learners that take no weights. A row is repeated round(largest class / its class) times, which at most
    multiplies the largest class by the number of classes.
    """
    counts = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.select(F.max("_n")).scalar()
    copies = checkpoint(counts.select(col(label), F.round(largest / F.col("_n")).cast("long").alias("_copies")))
    # A row becomes about sqrt(copies) rows, which are dealt out before each is repeated as often.
    parts = F.ceil(F.sqrt("_copies"))
    first = join_on(df, small(copies), [label]).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    share = F.floor(F.col("_copies") / parts) + (F.col("_part") < F.col("_copies") % parts).cast("long")
    spread = first.withColumn("_share", share).hint("rebalance")
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_share")))).drop("_copy", "_copies", "_part", "_share")


def _training_rows(train: DataFrame, label: str, vector: str, weight: str | None, fold: str | None) -> DataFrame:
    """x, y, w, fold of the training rows as a table that every pass reads: balanced class weights unless given."""
    weighted = with_class_weight(train, label, "_w") if weight is None else train.withColumn("_w", col(weight))
    return written(
        weighted.select(
            vector_to_array(vector).alias("x"), col(label).cast("long").alias("y"), F.col("_w").cast("double").alias("w"),
            (F.lit(-2) if fold is None else col(fold)).cast("int").alias("fold"),
        ),
        "training",
    )


def fit_svm(
    train: DataFrame, label: str, vector: str, classes: int, size: int, dimensions: int = 256,
    seed: int = 42, c: float = SVM_C, iterations: int = 50,
):
    """Balanced RBF-like support vector machine on z-scored vectors; returns a function that scores a table.

    ``gamma`` follows the 'scale' rule 1 / (features * variance), which is 1 / features after z-scoring. All classes are
    fitted in the same passes. Scores are added as ``rawPrediction`` (two classes: of class 1) and ``prediction``.
    """
    rows = _training_rows(train, label, vector, None, None)
    model = KernelSvm(size, dimensions, classes, 1.0 / size, 1.0 / (c * max(1, rows.count())), seed)
    few = few_tasks(rows)
    fitted = minimise(lambda p: gradient_sums(rows, model, p, [-1], few), model.start()[None], iterations)[0]

    @F.pandas_udf("array<double>")
    def scores(batch: pd.Series) -> pd.Series:
        return pd.Series(list(model.scores(fitted, np.stack(batch.to_numpy()))))

    def score(table: DataFrame) -> DataFrame:
        ship(table.sparkSession)
        scored = table.withColumn("_s", scores(vector_to_array(vector)))
        if classes == 2:
            prediction, raw = (F.col("_s")[0] > 0).cast("double"), F.col("_s")[0]
        else:
            prediction, raw = (F.array_position("_s", F.array_max("_s")) - 1).cast("double"), array_to_vector("_s")
        return scored.withColumns({"rawPrediction": raw, "prediction": prediction}).drop("_s")

    return score


def fit_perceptrons(
    train: DataFrame, label: str, vector: str, classes: int, size: int, seed: int = 42, iterations: int = 50,
    hidden: Sequence[int] = HIDDEN_LAYERS, weight: str | None = None, fold: str | None = None, folds: int = 1,
):
    """Perceptrons with weighted cross-entropy; with ``fold`` one for each fold, which does not see it, in the same passes.

    Weights are the balanced ones of the classes, or the column ``weight``. Returns a function (table, number) that adds
    ``probability``, ``rawPrediction`` and ``prediction`` of the numbered network.
    """
    rows = _training_rows(train, label, vector, weight, fold)
    model = Perceptron([size, *hidden, classes])
    held = [-1] if fold is None else list(range(folds))
    start = np.stack([model.start(seed)] * len(held))
    few = few_tasks(rows)
    fitted = minimise(lambda p: gradient_sums(rows, model, p, held, few), start, iterations)

    def score(table: DataFrame, number: int = 0) -> DataFrame:
        parameters = fitted[number]
        ship(table.sparkSession)

        @F.pandas_udf("array<double>")
        def logs(batch: pd.Series) -> pd.Series:
            return pd.Series(list(model.log_probabilities(parameters, np.stack(batch.to_numpy()))))

        scored = table.withColumn("_l", logs(vector_to_array(vector)))
        best = (F.array_position("_l", F.array_max("_l")) - 1).cast("double")
        added = {"rawPrediction": array_to_vector("_l"), "probability": array_to_vector(F.transform("_l", F.exp)), "prediction": best}
        return scored.withColumns(added).drop("_l")

    return score


def fit_perceptron(train: DataFrame, label: str, vector: str, classes: int, size: int, **options):
    """One class-balanced perceptron; returns a function that scores a table."""
    return fit_perceptrons(train, label, vector, classes, size, **options)


def log_loss(scored: DataFrame, label: str) -> DataFrame:
    """(metric, value): mean negative log probability of the true class."""
    p = vector_to_array("probability")[col(label).cast("int")]
    return scored.agg(F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("value")).select(
        F.lit("loss").alias("metric"), "value"
    )


def model_metrics(scored: DataFrame, label: str, binary: bool) -> DataFrame:
    """(metric, value) of a scored table: overall metrics, and for binary labels per side and the AUC."""
    predictions = scored.select(col(label).cast("int").alias("y"), F.col("prediction").cast("int").alias("p"))
    confusion = checkpoint(confusion_counts(predictions, "y", "p"))
    result = overall_metrics(confusion)
    if binary:
        sides = class_report(confusion)
        for code, name in ((0, "benign"), (1, "malicious")):
            part = sides.where(F.col("class") == code).select(
                *[F.col(m).alias(f"{name}_{m}") for m in ("precision", "recall", "f1")]
            )
            result = result.unionByName(part.unpivot([], part.columns, "metric", "value"))
        auc = BinaryClassificationEvaluator(labelCol=label, numBins=0).evaluate(scored)
        result = result.unionByName(scored.sparkSession.createDataFrame([("auc", float(auc))], "metric string, value double"))
    return result


def evaluate_svm(
    train: DataFrame, test: DataFrame, label: str, vector: str, classes: int, size: int, **options
) -> DataFrame:
    """(metric, value) of a support vector machine fitted on ``train`` and scored on ``test``."""
    return model_metrics(fit_svm(train, label, vector, classes, size, **options)(test), label, classes == 2)


def perceptron_folds(
    train: DataFrame, label: str, vector: str, keys: Sequence[str], classes: int, size: int, folds: int = 5,
    seed: int = 42, iterations: int = 50,
) -> DataFrame:
    """(fold, metric, value) of a stratified cross-validation, with loss, AUC (binary) and training accuracy."""
    parts = written(stratified_folds(train, label, keys, folds, seed), "folds")
    score = fit_perceptrons(parts, label, vector, classes, size, seed, iterations, fold="fold", folds=folds)
    result = None
    for fold in range(folds):
        scored = checkpoint(score(parts, fold))
        inside, outside = scored.where(F.col("fold") != fold), scored.where(F.col("fold") == fold)
        fitted = inside.agg(F.avg((col(label) == F.col("prediction")).cast("double")).alias("value"))
        metrics = model_metrics(outside, label, classes == 2).unionByName(log_loss(outside, label))
        metrics = metrics.unionByName(fitted.select(F.lit("train_accuracy").alias("metric"), "value"))
        metrics = metrics.select(F.lit(fold).alias("fold"), "metric", "value")
        result = metrics if result is None else result.unionByName(metrics)
    result = checkpoint(result)
    return result.unionByName(generalization_gap(result))


def cross_validate_perceptron(
    train: DataFrame, label: str, vector: str, keys: Sequence[str], classes: int, size: int, **options
) -> DataFrame:
    """(metric, average, std_dev) over the folds."""
    return fold_summary(perceptron_folds(train, label, vector, keys, classes, size, **options))


def evaluate_perceptron(
    train: DataFrame, test: DataFrame, label: str, vector: str, classes: int, size: int, **options
) -> DataFrame:
    """(metric, value) of a perceptron fitted on ``train`` and scored on rows it has not seen."""
    model = fit_perceptron(train, label, vector, classes, size, **options)
    scored = checkpoint(model(test))
    return model_metrics(scored, label, classes == 2).unionByName(log_loss(scored, label))
