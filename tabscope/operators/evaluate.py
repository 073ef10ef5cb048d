"""Evaluation of predictions: confusion matrix, class report, AUC, comparison tables and summaries.

Only the confusion matrix reads the predictions; everything else is arithmetic on classes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.aggregates import join_on
from tabscope.functions.scalars import col, normalized_difference
from tabscope.operators.profile import category_percentages, to_long
from tabscope.operators.ranking import pick_rows

# Fixed values.
TOP_DIFFERENCES = 10
MIN_CLASSES_FOR_EXTREMES = 7
EXTREME_CLASSES = 3


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(actual, predicted, count) for the pairs of classes that occur; a null is a class.

    Reports and metrics need no more: their sums run over these rows, however many classes there are.
    """
    return df.groupBy(col(label).alias("actual"), col(prediction).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``confusion_counts`` with a zero for every other pair of occurring classes: for few classes, to be shown as a grid."""
    counts = confusion_counts(df, label, prediction)
    found = counts.select(F.col("actual").alias("c")).union(counts.select("predicted")).distinct()
    # One row that holds the list of classes (a null among them, wrapped), unfolded along both axes.
    classes = found.agg(F.sort_array(F.collect_list(F.struct("c"))).alias("cs"))
    grid = classes.select("cs", F.explode("cs").alias("a")).select("a", F.explode("cs").alias("p"))
    grid = grid.select(F.col("a.c").alias("actual"), F.col("p.c").alias("predicted"))
    return join_on(grid, counts, ["actual", "predicted"], "left").fillna(0, ["count"])


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def class_report(confusion: DataFrame) -> DataFrame:
    """(class, precision, recall, f1, support) of each class; undefined ratios are 0."""
    n = F.col("count")
    ends = F.array(
        F.struct(F.col("actual").alias("class"), n.alias("support"), F.lit(0).cast("long").alias("said")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("long").alias("support"), n.alias("said")),
    )
    hit = F.when(F.col("actual").eqNullSafe(F.col("predicted")), n).otherwise(0)
    parts = confusion.withColumn("hit", hit).select("hit", F.posexplode(ends).alias("side", "e"))
    totals = parts.groupBy(F.col("e.class").alias("class")).agg(
        F.sum(F.when(F.col("side") == 0, F.col("hit")).otherwise(0)).alias("hits"),
        F.sum("e.support").alias("support"), F.sum("e.said").alias("said"),
    )
    precision, recall = _ratio(F.col("hits"), F.col("said")), _ratio(F.col("hits"), F.col("support"))
    return totals.select(
        "class", precision.alias("precision"), recall.alias("recall"),
        _ratio(F.col("hits") * 2, F.col("said") + F.col("support")).alias("f1"), "support",
    )


def overall_metrics(confusion: DataFrame) -> DataFrame:
    """(metric, value): accuracy, and weighted and macro precision, recall and f1."""
    report = class_report(confusion)
    # The macro mean covers every class that occurs, as a label or as a prediction.
    weighted = [
        _ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(f"weighted_{m}")
        for m in ("precision", "recall", "f1")
    ]
    macro = [F.coalesce(F.avg(m), F.lit(0.0)).alias(f"macro_{m}") for m in ("precision", "recall", "f1")]
    accuracy = _ratio(F.sum(F.col("recall") * F.col("support")), F.sum("support")).alias("accuracy")
    wide = report.agg(accuracy, *weighted, *macro)
    return wide.unpivot([], wide.columns, "metric", "value")


def report_with_training_only(
    test: DataFrame, train: DataFrame, label: str, prediction: str
) -> DataFrame:
    """Class report of the test rows; classes that only train get zeros and their training row count."""
    report = class_report(confusion_counts(test, label, prediction)).where(F.col("support") > 0)
    trained = train.groupBy(col(label).alias("class")).agg(F.count(F.lit(1)).alias("_rows"))
    only = F.col("support").isNull()
    joined = report.join(trained, "class", "full")
    return joined.select(
        "class",
        *[F.coalesce(m, F.lit(0.0)).alias(m) for m in ("precision", "recall", "f1")],
        F.coalesce("support", F.lit(0)).alias("support"),
        only.alias("training_only"),
        F.when(only, F.col("_rows")).alias("training_samples"),
    )


def class_results(test: DataFrame, train: DataFrame, label: str, prediction: str, classes: DataFrame) -> DataFrame:
    """(class, status, precision, recall, f1, support, training_samples) of every class that there is or should be.

    ``classes`` has the expected ones in its first column. Status is ``tested``, ``training_only`` (no test row), ``predicted_only`` (neither,
    but given as a prediction) or ``missing`` (expected, but nowhere). Classes without test rows have zeros. Rows per class only.
    """
    report = class_report(confusion_counts(test, label, prediction)).withColumnRenamed("support", "_support")
    trained = train.groupBy(col(label).alias("class")).agg(F.count(F.lit(1)).alias("_trained"))
    known = join_on(trained, report, ["class"], "left_anti").select("class")
    expected = classes.select(col(classes.columns[0]).alias("class")).distinct()
    absent = join_on(join_on(expected, report, ["class"], "left_anti"), known, ["class"], "left_anti")
    rows = report.unionByName(known.unionByName(absent), allowMissingColumns=True)
    joined = join_on(rows, trained, ["class"], "left")
    support, training = F.coalesce("_support", F.lit(0)), F.coalesce("_trained", F.lit(0))
    status = (
        F.when(support > 0, "tested").when(training > 0, "training_only")
        .when(F.col("_support").isNotNull(), "predicted_only").otherwise("missing")
    )
    return joined.select(
        "class", status.alias("status"), *[F.coalesce(m, F.lit(0.0)).alias(m) for m in ("precision", "recall", "f1")],
        support.cast("long").alias("support"), training.cast("long").alias("training_samples"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """(rows, auc): exact area under the ROC curve, ties counted half.

    The evaluator counts positives and negatives per distinct score, sorts the scores across the cluster
    and adds up partial areas; ``numBins=0`` keeps it from thinning the curve.
    """
    scored = df.select(col(label).cast("double").alias("label"), col(score).cast("double").alias("score"))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    rows = scored.count()
    return df.sparkSession.createDataFrame([(rows, evaluator.evaluate(scored))], "rows long, auc double")


def f1_extremes(
    report: DataFrame, n: int = EXTREME_CLASSES, min_classes: int = MIN_CLASSES_FOR_EXTREMES
) -> DataFrame:
    """(end, rank, class, f1, support): the best and worst classes by f1, if there are enough classes."""
    # One row per class.
    best = Window.orderBy(F.col("f1").desc(), F.col("class"))
    worst = Window.orderBy(F.col("f1"), F.col("class"))
    enough = report.select(F.count(F.lit(1))).scalar() >= min_classes
    ranked = report.where(enough)
    ends = [
        ranked.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select(
            F.lit(e).alias("end"), "rank", "class", "f1", "support"
        )
        for e, w in (("top", best), ("bottom", worst))
    ]
    return ends[0].unionByName(ends[1])


def results_table(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """(dataset, metric...) from long rows (dataset, metric, value); datasets with an ``error`` are left out."""
    failed = metrics.where(F.col("metric") == "error").select("dataset").distinct()
    return (
        metrics.join(failed, "dataset", "left_anti")
        .groupBy("dataset")
        .pivot("metric", list(names))
        .agg(F.first("value"))
    )


def fold_summary(fold_metrics: DataFrame) -> DataFrame:
    """(metric, average, std_dev) over the folds, with the population deviation."""
    return fold_metrics.groupBy("metric").agg(
        F.avg("value").alias("average"), F.stddev_pop("value").alias("std_dev")
    )


def generalization_gap(fold_metrics: DataFrame) -> DataFrame:
    """(fold, metric, value): training minus validation accuracy of each fold."""
    def of(metric: str) -> Column:
        return F.max(F.when(F.col("metric") == metric, F.col("value")))

    return fold_metrics.groupBy("fold").agg((of("train_accuracy") - of("accuracy")).alias("value")).select(
        "fold", F.lit("generalization_gap").alias("metric"), "value"
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """(class, count, percentage) with whole names."""
    return category_percentages(df, [label]).select(col(label).cast("string").alias("class"), "count", "percentage")


def mean_differences(
    df: DataFrame, features: Sequence[str], label: str, n: int = TOP_DIFFERENCES,
    malicious_rows: int | None = None, keys: Sequence[str] = (), seed: int = 42,
) -> DataFrame:
    """The features whose class means differ most, relative to the larger mean.

    ``label`` is 0/1. ``malicious_rows`` compares against that many random malicious rows instead of all.
    """
    rows = df
    if malicious_rows is not None:
        malicious = pick_rows(df.where(col(label) == 1), malicious_rows, keys, seed)
        rows = df.where(col(label) == 0).unionByName(malicious)
    side = F.col(label)
    means = to_long(rows, list(features), [label]).groupBy("feature").agg(
        F.avg(F.when(side == 0, F.col("value"))).alias("benign_mean"),
        F.avg(F.when(side == 1, F.col("value"))).alias("malicious_mean"),
    )
    difference = normalized_difference(F.col("benign_mean"), F.col("malicious_mean"))
    return means.withColumn("difference", difference).orderBy(F.col("difference").desc(), "feature").limit(n)
