"""The three stages from raw table to evaluated classifiers, each writing its results below a folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.functions.scalars import col, encode_label_tolerant
from tabscope.operators import association, cluster_sampling, columns, correlate, distances, evaluate, models, profile, quality, reduce, sampling, select
from tabscope.operators.encode import Preprocessor, complete, label_index, standard_scale
from tabscope.session import checkpoint
from tabscope.sources import sinks


def profile_table(
    df: DataFrame, out: str, label: str = "Label", class_column: str = "Traffic Type", benign: str = "Benign"
) -> DataFrame:
    """Stage 1: describe, histograms, box statistics, correlations. Returns the long correlation table."""
    numeric = columns.numeric_columns(df)
    rows = df.count()
    described = checkpoint(profile.describe(df, rows=rows))
    flags = profile.distribution_flags(described)
    sinks.write_csv(profile.describe_table(described), f"{out}/data_description", single=True)
    sinks.write_csv(columns.column_listing(df), f"{out}/data_dtypes", single=True)
    sinks.write_csv(profile.null_counts(df), f"{out}/missing_values", single=True)
    sinks.write_csv(flags, f"{out}/data_flags", single=True)
    for name, by in (("all", []), ("label", [label]), ("class", [class_column])):
        sinks.write_csv(profile.histogram(df, numeric, by, rows=rows), f"{out}/histograms_{name}", single=True)
    for name, by in (("all", []), ("label", [label])):
        sinks.write_csv(profile.box_statistics(df, numeric, by, rows=rows), f"{out}/box_statistics_{name}", single=True)
    long = checkpoint(correlate.feature_correlations(df, label, class_column, benign))
    sinks.write_csv(correlate.correlation_matrix(long), f"{out}/correlation_matrix", single=True)
    sinks.write_csv(correlate.high_correlation_pairs(long), f"{out}/high_correlation_pairs", single=True)
    chosen = [r["feature"] for r in profile.problematic_features(flags).collect()]
    if chosen:
        found = checkpoint(association.feature_label_association(df, chosen, label, benign))
        sinks.write_csv(found, f"{out}/feature_label_association", single=True)
        lines = sinks.association_lines(association.association_summary(found), found)
        sinks.write_lines(lines, f"{out}/association_report")
    return long


def reduce_table(
    df: DataFrame, long: DataFrame, keys: Sequence[str], out: str, label: str = "Label",
    class_column: str = "Traffic Type", sample_size: int = 10_000, drop: Sequence[str] = (),
    inits: int = 10, seed: int = 42,
) -> dict[str, DataFrame]:
    """Stage 2: feature selection, variance comparison, and three row samples with their quality.

    Returns the samples by name, without columns that are constant in the sample.
    """
    targets = [label, class_column]
    pairs = correlate.high_correlation_pairs(long)
    rest = columns.drop_columns(df, keys)
    selection = checkpoint(
        select.feature_selection(rest, pairs, select.target_scores(long, targets), targets, drop=drop)
    )
    sinks.write_lines(sinks.group_lines(select.correlation_groups(pairs)), f"{out}/correlation_groups")
    for status in ("selected", "dropped"):
        sinks.write_lines(sinks.selection_lines(selection, status), f"{out}/{status}_features")
    kept = select.selected_columns(rest, selection)
    features = [c for c in kept if c not in targets]
    original = columns.numeric_columns(rest, exclude=targets)
    variance = reduce.pca_variance(df, original, features)
    sinks.write_lines(
        sinks.variance_lines(reduce.pca_summary(variance, len(original), len(features))), f"{out}/variance"
    )
    narrow = df.select(*[col(c) for c in dict.fromkeys([*keys, *kept])])
    samples = {
        "stratified": sampling.stratified_sample(narrow, targets, keys, sample_size, seed, top_up=class_column),
        "kmeans": cluster_sampling.kmeans_sample(
            narrow, targets, features, keys, sample_size, seed, inits, top_up=class_column
        ),
        "density": cluster_sampling.density_sample(
            narrow, targets, features, keys, sample_size, seed, top_up=class_column
        ),
    }
    result = {}
    for name, sample in samples.items():
        sample = checkpoint(sample)
        sinks.write_csv(sampling.shuffle_rows(sample, keys, seed), f"{out}/sample_{name}")
        sinks.write_lines(quality.quality_report(narrow, sample, targets), f"{out}/quality_{name}")
        result[name] = profile.remove_zero_variance_columns(sample, keep=[*targets, *keys])
    return result


def spark_values(spark: SparkSession, values: Sequence[str]) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in values])).alias("class"))


def diagnose(split: DataFrame, keys: Sequence[str], out: str, seed: int) -> None:
    """After the binary task: features whose class means differ most, and distances within and between the sides."""
    features = columns.numeric_columns(split, exclude=[*keys, "_binary", "_class"])
    sinks.write_csv(evaluate.mean_differences(split, features, "_binary"), f"{out}/means", single=True)
    scaled = standard_scale(split.withColumns({c: complete(col(c)) for c in features}), features)
    vector = F.array(*[complete(col(c)) for c in features])
    distinct = scaled.dropDuplicates(list(keys))
    sinks.write_csv(distances.neighbour_diagnosis(distinct, "_binary", keys, vector, seed), f"{out}/distances", single=True)


def classify_samples(
    samples: dict[str, DataFrame], keys: Sequence[str], out: str, label: str = "Label",
    class_column: str = "Traffic Type", preprocessor: Preprocessor | None = None, iterations: int = 50,
    folds: int = 5, seed: int = 42,
) -> DataFrame:
    """Stage 3: perceptrons and support vector machines on each sample, binary and multiclass.

    A preprocessor is fitted for each sample and task, on its own training rows. Copies made by a rare-class
    top-up have the key of their original and so fall on the same side of a split. Beside the metrics there are, per class,
    the results of the support vector machines as nested JSON, with classes that only train or are missing from a sample
    though another has them, the best and worst classes, and for the binary task what tells its sides apart.
    Returns (task, model, dataset, metric, value).
    """
    parts, reports = [], []
    # A column that is constant in one sample is missing there; only shared columns are encoded.
    shared = set.intersection(*[set(s.columns) for s in samples.values()])
    everywhere = None
    for sample in samples.values():
        found = sample.select(col(class_column).alias("class")).distinct()
        everywhere = found if everywhere is None else everywhere.union(found)
    everywhere = checkpoint(everywhere.distinct())
    for name, sample in samples.items():
        sample = sample.select(*[col(c) for c in sample.columns if c in shared])
        numeric = dict(sample.dtypes)[label] != "string"
        coded = label_index(sample, class_column, "_class").withColumn(
            "_binary", encode_label_tolerant(col(label), numeric)
        )
        classes = coded.select("_class").distinct().count()
        for task, target, count in (("binary", "_binary", 2), ("multiclass", "_class", classes)):
            split = checkpoint(sampling.rare_aware_split(coded, target, keys, seed=seed))
            fitted = replace(preprocessor) if preprocessor else Preprocessor(exclude=[*keys, "_binary", "_class"])
            fitted.fit(split.where(F.col("split") == "train"))
            vectors = checkpoint(fitted.transform(split, keep=[*keys, target, "split"]))
            train, test = (vectors.where(F.col("split") == s) for s in ("train", "test"))
            size = fitted.width()
            machine = models.fit_svm(train, target, "features", count, size, seed=seed, iterations=iterations)
            scored = checkpoint(machine(test))
            if task == "multiclass":
                names = coded.select(F.col("_class").alias("code"), col(class_column).alias("class")).distinct()
                named = lambda rows, code: rows.join(names, F.col(code) == F.col("code")).select("class")
                said = scored.withColumnRenamed("_class", "_true").join(names.select(F.col("code").alias("_t"), F.col("class").alias("actual")), F.col("_true") == F.col("_t"))
                said = said.join(names.select(F.col("code").alias("_p"), F.col("class").alias("said")), F.col("prediction") == F.col("_p"))
                trained = named(train, "_class").withColumnRenamed("class", "actual")
                expected = everywhere
            else:
                said, trained = (rows.withColumn("actual", F.col("_binary").cast("string")) for rows in (scored, train))
                said = said.withColumn("said", F.col("prediction").cast("int").cast("string"))
                expected = spark_values(sample.sparkSession, ["0", "1"])
                diagnose(split, keys, f"{out}/diagnosis_{name}", seed)
            report = checkpoint(evaluate.class_results(said, trained, "actual", "said", expected))
            reports.append(report.select(F.lit(name).alias("dataset"), F.lit(task).alias("task"), "*"))
            extremes = evaluate.f1_extremes(report.where("support > 0"))
            sinks.write_csv(extremes, f"{out}/{task}_{name}_extremes", single=True)
            absent = sampling.missing_classes(expected, trained.select(F.col("actual").alias(expected.columns[0])), expected.columns[0])
            sinks.write_csv(absent, f"{out}/{task}_{name}_missing_classes", single=True)
            results = {
                "svm": models.model_metrics(scored, target, count == 2),
                "perceptron": models.evaluate_perceptron(
                    train, test, target, "features", count, size, seed=seed, iterations=iterations
                ),
            }
            summary = models.cross_validate_perceptron(
                train, target, "features", keys, count, size, folds=folds, seed=seed, iterations=iterations
            )
            sinks.write_csv(summary, f"{out}/{task}_{name}_folds", single=True)
            for model, metrics in results.items():
                parts.append(
                    checkpoint(
                        metrics.select(
                            F.lit(task).alias("task"), F.lit(model).alias("model"), F.lit(name).alias("dataset"),
                            "metric", "value",
                        )
                    )
                )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    for task, names in (
        ("binary", ["accuracy", "weighted_f1", "benign_f1", "malicious_f1", "auc"]),
        ("multiclass", ["accuracy", "weighted_f1"]),
    ):
        svm = result.where((F.col("task") == task) & (F.col("model") == "svm"))
        sinks.write_csv(evaluate.results_table(svm, names), f"{out}/{task}_results", single=True)
    every = reports[0]
    for report in reports[1:]:
        every = every.unionByName(report)
    sinks.write_class_json(every, f"{out}/class_results")
    sinks.write_metrics_json(result, f"{out}/detailed_results", by=("task", "model", "dataset"))
    return result
