"""Encoding, evaluation and classifiers. Evaluation queries use a rule as the prediction."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import unwrap_udt

from catalog.views import BASIC, KEYS, LI, NUMERIC, PORTS, digest_sql, emb, li, long_sql, ports, registrar, rounded, table
from tabscope.operators import columns, distances, encode, evaluate, models, sampling, training
from tabscope.session import checkpoint, scratch_path
from tabscope.sources import sinks

REGISTRY: dict = {}
query = registrar(REGISTRY)


@query(f"""
WITH train AS (SELECT * FROM lineitem WHERE l_linestatus = 'F'),
m AS (SELECT {', '.join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in BASIC)} FROM train)
SELECT {', '.join(KEYS)}, {', '.join(f"round(({c} - m_{c}) / s_{c}, 6) + 0.0 AS {c}" for c in BASIC)} FROM lineitem, m""")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(*KEYS, *BASIC, "l_linestatus")
    scaled = encode.standard_scale(rows, BASIC, fit_on=rows.where(F.col("l_linestatus") == "F"))
    return rounded(scaled.drop("l_linestatus"), 6, *BASIC)


@query("""
SELECT p_partkey, coalesce(code, -1) AS code FROM part
LEFT JOIN (SELECT p_size, dense_rank() OVER (ORDER BY p_size) - 1 AS code
  FROM (SELECT DISTINCT p_size FROM part WHERE p_type = 'ECONOMY' AND p_size % 3 <> 0)) d USING (p_size)""")
def ordinal_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    known = columns.dictionary(part.where((F.col("p_type") == "ECONOMY") & (F.col("p_size") % 3 != 0)), "p_size")
    return encode.ordinal_encode(part, "p_size", known).select("p_partkey", "code")


@query("""
SELECT o_orderkey, (o_orderstatus = 'F')::INTEGER AS "o_orderstatus=F", (o_orderstatus = 'O')::INTEGER AS "o_orderstatus=O"
FROM orders""")
def one_hot_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    known = encode.categories(orders.where(F.col("o_orderstatus") != "P"), "o_orderstatus")
    return orders.select("o_orderkey", *encode.one_hot("o_orderstatus", known))


@query("""
WITH codes AS (SELECT c_custkey, dense_rank() OVER (ORDER BY c_custkey) - 1 AS code FROM customer WHERE c_custkey % 5 <> 0),
n AS (SELECT count(*) AS size FROM codes)
SELECT o_orderkey, size, code AS at FROM orders LEFT JOIN codes ON o_custkey = c_custkey, n""")
def one_hot_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with as many categories as customers: the place of the 1 of each sparse vector, null for unknown ones."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 5 != 0).select(F.col("c_custkey").alias("o_custkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    coded = encode.one_hot_vector(orders, "o_custkey", columns.dictionary(customers, "o_custkey"), "hot")
    hot = unwrap_udt("hot")
    return coded.select("o_orderkey", hot["size"].cast("long").alias("size"), F.get(hot["indices"], F.lit(0)).cast("long").alias("at"))


def _gradient_sql() -> str:
    classes = {"A": 0, "N": 1, "R": 2}
    code = "CASE l_returnflag " + " ".join(f"WHEN '{c}' THEN {i}" for c, i in classes.items()) + " END"
    entries = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {k} AS class, sum(w * (1.0 / 3 - (y = {k})::INTEGER) * {f}) / sum(w) AS gradient FROM weighted"
        for f in BASIC for k in range(3)
    )
    return f"""
WITH coded AS (SELECT *, {code} AS y FROM lineitem), sizes AS (SELECT y, count(*) AS n FROM coded GROUP BY y),
weighted AS (SELECT coded.*, (SELECT count(*) FROM coded) / (3.0 * n) AS w FROM coded JOIN sizes USING (y)),
entries AS ({entries}) SELECT feature, class, round(gradient, 6) + 0.0 AS gradient FROM entries"""


@query(_gradient_sql())
def weighted_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gradient of a class-weighted network without hidden layers at its zero point, for each feature and class."""
    rows = encode.label_index(table(spark, sf_dir, "lineitem").select(*BASIC, "l_returnflag"), "l_returnflag", "y")
    vector = F.array(*BASIC).alias("x")
    weighted = models.with_class_weight(rows, "y", "w").select(vector, "y", F.col("w").cast("double"), F.lit(0).alias("fold"))
    model = training.Perceptron([len(BASIC), 3])
    _, slope = training.gradient_sums(weighted, model, np.zeros((1, 3 * len(BASIC) + 3)), [-1])
    found = [(f, k, float(slope[0, 3 * i + k])) for i, f in enumerate(BASIC) for k in range(3)]
    return rounded(spark.createDataFrame(found, "feature string, class int, gradient double"), 6, "gradient")


@query("SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS label_index FROM orders")
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return encode.label_index(orders, "o_orderpriority").drop("o_orderpriority")


def _flags(port: str) -> list[str]:
    return [
        f"{port} <= 1023", f"{port} > 1023 AND {port} <= 49151", f"{port} > 49151",
        f"{port} IN (80, 443, 8080, 8443)", f"{port} IN (25, 465, 587, 110, 143, 993, 995)",
        f"{port} IN (20, 21, 22, 69)", f"{port} IN (53)",
    ]


SCALED = ["l_linenumber", "l_quantity", "src_port", "dst_port"]
ENCODED = [
    *[f"round(({c} - m_{c}) / s_{c}, 6) + 0.0" for c in SCALED],
    "l_linenumber - 1",
    *_flags("src_port"), *_flags("dst_port"),
    *[f"l_linenumber = {i}" for i in range(1, 8)],
]


@query(f"""
WITH {PORTS}, m AS (SELECT {', '.join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in SCALED)} FROM ports)
SELECT l_orderkey, l_partkey, l_suppkey, {', '.join(f"({e})::DOUBLE AS f{i}" for i, e in enumerate(ENCODED))} FROM ports, m""")
def column_preprocessor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ports(spark, sf_dir)
    kept = ["l_orderkey", "l_partkey", "l_suppkey"]
    fitted = encode.Preprocessor(
        ordinal_columns=["l_linenumber"], port_columns=["src_port", "dst_port"], one_hot_columns=["l_linenumber"],
        exclude=kept,
    ).fit(rows)
    values = fitted.transform(rows, keep=kept).withColumn("v", vector_to_array("features"))
    width = len(ENCODED)
    return values.select(*kept, *[(F.round(F.col("v")[i], 6) + 0.0).alias(f"f{i}") for i in range(width)])


# A rule that is right for part of the rows.
RULED = """ruled AS (
  SELECT *, CASE WHEN l_quantity < 10 THEN 'A' WHEN l_discount > 0.07 THEN 'N' ELSE l_returnflag END AS said FROM lineitem)"""


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = (
        F.when(F.col("l_quantity") < 10, "A").when(F.col("l_discount") > 0.07, "N").otherwise(F.col("l_returnflag"))
    )
    return table(spark, sf_dir, "lineitem").drop("l_shipdate").withColumn("said", said)


def _report(source: str, actual: str, predicted: str) -> str:
    return f"""classes AS (SELECT {actual} AS class FROM {source} UNION SELECT {predicted} FROM {source}),
totals AS (
  SELECT class, (SELECT count(*) FROM {source} WHERE {actual} = class AND {predicted} = class) AS hits,
    (SELECT count(*) FROM {source} WHERE {actual} = class) AS support,
    (SELECT count(*) FROM {source} WHERE {predicted} = class) AS said FROM classes),
report AS (
  SELECT class, CASE WHEN said = 0 THEN 0 ELSE hits / said END AS precision,
    CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall,
    CASE WHEN said + support = 0 THEN 0 ELSE 2 * hits / (said + support) END AS f1, support FROM totals)"""


ROUNDED_REPORT = "class, round(precision, 6) + 0.0 AS precision, round(recall, 6) + 0.0 AS recall, round(f1, 6) + 0.0 AS f1, support"


@query(f"""
WITH {RULED}, classes AS (SELECT l_returnflag AS c FROM ruled UNION SELECT said FROM ruled)
SELECT a.c AS actual, b.c AS predicted, (SELECT count(*) FROM ruled WHERE l_returnflag = a.c AND said = b.c) AS count
FROM classes a, classes b""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(ruled(spark, sf_dir), "l_returnflag", "said")


@query(f"""
WITH ruled AS (SELECT o_custkey AS actual, o_custkey + (o_orderkey % 4 = 0)::INTEGER AS said FROM orders), {_report('ruled', 'actual', 'said')}
SELECT {ROUNDED_REPORT} FROM report""")
def sparse_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report over as many classes as customers, from the pairs that occur."""
    wrong = (F.col("o_orderkey") % 4 == 0).cast("int")
    said = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("actual"), (F.col("o_custkey") + wrong).alias("said"))
    return rounded(evaluate.class_report(evaluate.confusion_counts(said, "actual", "said")), 6, "precision", "recall", "f1")


TESTED = "o_orderstatus = 'P' AND o_orderpriority <> '5-LOW'"
TRAINED = "o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'"


@query(f"""
WITH expected AS (SELECT DISTINCT o_orderpriority AS class FROM orders UNION SELECT '0-NEVER'),
ruled AS (SELECT o_orderpriority AS actual, CASE WHEN o_totalprice > 200000 THEN '2-HIGH' ELSE o_orderpriority END AS said
  FROM orders WHERE {TESTED} AND o_orderpriority <> '4-NOT SPECIFIED'), {_report('ruled', 'actual', 'said')},
trained AS (SELECT o_orderpriority AS class, count(*) AS training_samples FROM orders WHERE {TRAINED} GROUP BY 1)
SELECT 'orders' AS dataset, 'multiclass' AS task, class,
  CASE WHEN coalesce(support, 0) > 0 THEN 'tested' WHEN coalesce(training_samples, 0) > 0 THEN 'training_only'
    WHEN support IS NOT NULL THEN 'predicted_only' ELSE 'missing' END AS status,
  round(coalesce(precision, 0), 6) + 0.0 AS precision, round(coalesce(recall, 0), 6) + 0.0 AS recall, round(coalesce(f1, 0), 6) + 0.0 AS f1,
  coalesce(support, 0) AS support, coalesce(training_samples, 0) AS training_samples
FROM expected FULL JOIN report USING (class) FULL JOIN trained USING (class)""")
def classify_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of every class by a rule, written as nested JSON and read again."""
    orders = table(spark, sf_dir, "orders")
    said = F.when(F.col("o_totalprice") > 200000, "2-HIGH").otherwise(F.col("o_orderpriority"))
    test = orders.where(TESTED).where("o_orderpriority <> '4-NOT SPECIFIED'").withColumn("said", said)
    never = orders.agg(F.lit("0-NEVER").alias("o_orderpriority"))
    expected = orders.select("o_orderpriority").distinct().union(never)
    results = evaluate.class_results(test, orders.where(TRAINED), "o_orderpriority", "said", expected)
    path = scratch_path(spark, "report")
    sinks.write_class_json(results.select(F.lit("orders").alias("dataset"), F.lit("multiclass").alias("task"), "*"), path)
    return rounded(sinks.read_class_json(spark, path), 6, "precision", "recall", "f1")


@query(f"""
WITH {RULED}, holes AS (SELECT nullif(l_returnflag, 'A') AS actual, nullif(said, 'N') AS predicted FROM ruled),
classes AS (SELECT actual AS c FROM holes UNION SELECT predicted FROM holes)
SELECT a.c AS actual, b.c AS predicted,
  (SELECT count(*) FROM holes h WHERE h.actual IS NOT DISTINCT FROM a.c AND h.predicted IS NOT DISTINCT FROM b.c) AS count
FROM classes a, classes b""")
def confusion_matrix_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    holes = ruled(spark, sf_dir).select(
        F.nullif("l_returnflag", F.lit("A")).alias("actual"), F.nullif("said", F.lit("N")).alias("predicted")
    )
    return evaluate.confusion_matrix(holes, "actual", "predicted")


@query(f"WITH {RULED}, {_report('ruled', 'l_returnflag', 'said')} SELECT {ROUNDED_REPORT} FROM report")
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = evaluate.confusion_matrix(ruled(spark, sf_dir), "l_returnflag", "said")
    return rounded(evaluate.class_report(confusion), 6, "precision", "recall", "f1")


@query(f"""
WITH {RULED}, {_report('ruled', 'l_returnflag', 'said')}, o AS (
  SELECT sum(recall * support) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS weighted_precision,
    sum(recall * support) / sum(support) AS weighted_recall, sum(f1 * support) / sum(support) AS weighted_f1,
    avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1 FROM report)
SELECT metric, round(value, 6) + 0.0 AS value FROM o UNPIVOT (value FOR metric IN (COLUMNS(*)))""")
def overall_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    confusion = evaluate.confusion_matrix(ruled(spark, sf_dir), "l_returnflag", "said")
    return rounded(evaluate.overall_metrics(confusion), 6, "value")


@query(f"""
WITH {RULED}, test AS (SELECT * FROM ruled WHERE l_linestatus = 'F' AND l_returnflag <> 'R'),
train AS (SELECT l_returnflag AS class, count(*) AS trained FROM ruled WHERE l_linestatus = 'O' GROUP BY 1),
{_report('test', 'l_returnflag', 'said')}
SELECT class, round(coalesce(precision, 0), 6) + 0.0 AS precision, round(coalesce(recall, 0), 6) + 0.0 AS recall,
  round(coalesce(f1, 0), 6) + 0.0 AS f1, coalesce(support, 0) AS support, support IS NULL AS training_only,
  CASE WHEN support IS NULL THEN trained END AS training_samples
FROM (SELECT * FROM report WHERE support > 0) FULL JOIN train USING (class)""")
def training_only_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ruled(spark, sf_dir)
    test = rows.where((F.col("l_linestatus") == "F") & (F.col("l_returnflag") != "R"))
    train = rows.where(F.col("l_linestatus") == "O")
    report = evaluate.report_with_training_only(test, train, "l_returnflag", "said")
    return rounded(report, 6, "precision", "recall", "f1")


@query("""
WITH scored AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
    l_quantity + CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS score FROM lineitem),
per AS (SELECT score, sum(y) AS pos, count(*) - sum(y) AS neg FROM scored GROUP BY score),
cum AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM per)
SELECT (SELECT count(*) FROM scored) AS rows, round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 6) AS auc FROM cum""")
def roc_auc_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.col("l_returnflag") == "R"
    scored = table(spark, sf_dir, "lineitem").select(
        hit.cast("int").alias("y"),
        (F.col("l_quantity") + F.when(hit, F.col("l_linenumber")).otherwise(0)).alias("score"),
    )
    return rounded(evaluate.roc_auc(scored, "y", "score"), 6, "auc")


BRANDS = """brands AS (
  SELECT p_brand, CASE WHEN p_size % 5 = 0 THEN 'Brand#1' WHEN p_size > 40 AND p_brand < 'Brand#2' THEN 'Brand#2' ELSE p_brand END AS said FROM part)"""


@query(f"""
WITH {BRANDS}, {_report('brands', 'p_brand', 'said')},
ends AS (
  SELECT 'top' AS "end", row_number() OVER (ORDER BY f1 DESC, class) AS rank, * FROM report
  UNION ALL SELECT 'bottom', row_number() OVER (ORDER BY f1, class), * FROM report)
SELECT "end", rank::INTEGER AS rank, class, round(f1, 6) + 0.0 AS f1, support FROM ends WHERE rank <= 3""")
def class_f1_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, brand = F.col("p_size"), F.col("p_brand")
    said = F.when(size % 5 == 0, "Brand#1").when((size > 40) & (brand < "Brand#2"), "Brand#2").otherwise(brand)
    parts = table(spark, sf_dir, "part").select("p_brand", said.alias("said"))
    report = evaluate.class_report(evaluate.confusion_matrix(parts, "p_brand", "said"))
    return rounded(evaluate.f1_extremes(report), 6, "f1")


@query("""
SELECT l_linestatus AS dataset, round(avg(CASE WHEN l_quantity > 10 THEN 1 ELSE 0 END), 6) AS accuracy,
  round(avg(l_discount), 6) + 0.0 AS weighted_f1 FROM lineitem GROUP BY 1""")
def results_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = table(spark, sf_dir, "lineitem").groupBy(F.col("l_linestatus").alias("dataset")).agg(
        F.avg((F.col("l_quantity") > 10).cast("double")).alias("accuracy"), F.avg("l_discount").alias("weighted_f1")
    )
    metrics = wide.unpivot(["dataset"], ["accuracy", "weighted_f1"], "metric", "value")
    # A data set whose evaluation failed does not appear in the comparison.
    failed = wide.select(F.concat(F.lit("failed_"), "dataset").alias("dataset"), F.lit("error").alias("metric"), F.lit(1.0).alias("value"))
    table_ = evaluate.results_table(metrics.unionByName(failed), ["accuracy", "weighted_f1"])
    return rounded(table_, 6, "accuracy", "weighted_f1")


@query(f"""
WITH {RULED},
folded AS (SELECT *, ntile(5) OVER (PARTITION BY l_returnflag ORDER BY {digest_sql(42, KEYS)}, {', '.join(KEYS)}) - 1 AS fold FROM ruled),
per AS (SELECT fold, avg((l_returnflag = said)::INTEGER) AS accuracy, avg((l_returnflag = 'A')::INTEGER) AS train_accuracy FROM folded GROUP BY fold),
metrics AS (
  SELECT 'accuracy' AS metric, accuracy AS value FROM per UNION ALL SELECT 'train_accuracy', train_accuracy FROM per
  UNION ALL SELECT 'generalization_gap', train_accuracy - accuracy FROM per)
SELECT metric, round(avg(value), 6) + 0.0 AS average, round(stddev_pop(value), 6) + 0.0 AS std_dev FROM metrics GROUP BY metric""")
def fold_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = sampling.stratified_folds(ruled(spark, sf_dir), "l_returnflag", KEYS)
    per = folded.groupBy("fold").agg(
        F.avg((F.col("l_returnflag") == F.col("said")).cast("double")).alias("accuracy"),
        F.avg((F.col("l_returnflag") == "A").cast("double")).alias("train_accuracy"),
    )
    metrics = per.unpivot(["fold"], ["accuracy", "train_accuracy"], "metric", "value")
    summary = evaluate.fold_summary(metrics.unionByName(evaluate.generalization_gap(metrics)))
    return rounded(summary, 6, "average", "std_dev")


@query("""
SELECT o_orderpriority AS class, count(*) AS count,
  round(count(*) / sum(count(*)) OVER () * 100, 6) + 0.0 AS percentage FROM orders GROUP BY o_orderpriority""")
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(evaluate.class_distribution(table(spark, sf_dir, "orders"), "o_orderpriority"), 6, "percentage")


@query(f"""
WITH {LI}, coded AS (SELECT *, CASE WHEN label = 'Benign' THEN 0 ELSE 1 END AS y FROM li), long AS ({long_sql('coded', NUMERIC, ['y'])}),
m AS (SELECT feature, avg(value) FILTER (y = 0) AS b, avg(value) FILTER (y = 1) AS a FROM long GROUP BY feature),
d AS (SELECT *, CASE WHEN abs(a) <= 0.0001 AND abs(b) <= 0.0001 THEN 0 ELSE abs(b - a) / greatest(abs(b), abs(a), 1) END AS d FROM m)
SELECT feature, round(b, 4) + 0.0 AS benign_mean, round(a, 4) + 0.0 AS malicious_mean, round(d, 9) + 0.0 AS difference
FROM d ORDER BY d DESC, feature LIMIT 10""")
def mean_diff_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = li(spark, sf_dir).withColumn("y", F.when(F.col("label") == "Benign", 0).otherwise(1))
    found = evaluate.mean_differences(coded, NUMERIC, "y")
    return rounded(rounded(found, 4, "benign_mean", "malicious_mean"), 9, "difference")


# The benign side is half the classes, the malicious side the rest; all rows of both count.
@query("""
WITH points AS (SELECT vec_id, embedding::DOUBLE[] AS v, (label >= 5)::INTEGER AS y FROM embeddings),
benign AS (SELECT * FROM points WHERE y = 0),
malicious AS (SELECT * FROM points WHERE y = 1),
inside AS (SELECT a.vec_id, min(list_distance(a.v, b.v)) AS d FROM benign a JOIN benign b ON a.vec_id <> b.vec_id GROUP BY 1),
other AS (SELECT a.vec_id, min(list_distance(a.v, b.v)) AS d FROM malicious a JOIN malicious b ON a.vec_id <> b.vec_id GROUP BY 1),
across AS (SELECT list_distance(a.v, b.v) AS d FROM benign a, malicious b),
metrics AS (
  SELECT 'benign_nearest_min' AS metric, min(d) AS value FROM inside UNION ALL SELECT 'benign_nearest_max', max(d) FROM inside
  UNION ALL SELECT 'benign_nearest_mean', avg(d) FROM inside UNION ALL SELECT 'malicious_nearest_mean', avg(d) FROM other
  UNION ALL SELECT 'cross_min', min(d) FROM across UNION ALL SELECT 'cross_mean', avg(d) FROM across)
SELECT metric, round(value, 6) + 0.0 AS value FROM metrics""")
def nn_distance_diagnosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings").withColumn("y", (F.col("label") >= 5).cast("int"))
    found = distances.neighbour_diagnosis(points, "y", ["vec_id"], F.col("embedding").cast("array<double>"))
    return rounded(found, 6, "value")


def embedded(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, DataFrame, int]:
    """Embeddings with ``y``, split into training and test rows, scaled by the moments of the training rows, and their width."""
    rows, features = emb(spark, sf_dir)
    binary = (F.col("label") >= 5).cast("int")
    coded = rows.withColumn("y", binary if label == "binary" else F.col("label"))
    split = checkpoint(sampling.rare_aware_split(coded, "y", ["vec_id"]))
    train = split.where(F.col("split") == "train")
    scaled = encode.standard_scale(split, features, fit_on=train)
    vector = array_to_vector(F.array(*[encode.complete(F.col(c)) for c in features])).alias("features")
    vectors = scaled.select("vec_id", "label", "y", "split", vector)
    return vectors.where(F.col("split") == "train"), vectors.where(F.col("split") == "test"), len(features)


@query()
def svm_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, width = embedded(spark, sf_dir, "binary")
    return models.evaluate_svm(train, test, "y", "features", 2, width)


@query()
def svm_multiclass(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, width = embedded(spark, sf_dir, "multiclass")
    return models.evaluate_svm(train, test, "y", "features", 10, width)


@query()
def mlp_binary_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, width = embedded(spark, sf_dir, "binary")
    return models.cross_validate_perceptron(train, "y", "features", ["vec_id"], 2, width)


@query()
def mlp_multiclass_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, width = embedded(spark, sf_dir, "multiclass")
    return models.cross_validate_perceptron(train, "y", "features", ["vec_id"], 10, width)


@query()
def mlp_binary_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, width = embedded(spark, sf_dir, "binary")
    return models.evaluate_perceptron(train, test, "y", "features", 2, width)


@query()
def mlp_multiclass_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test, width = embedded(spark, sf_dir, "multiclass")
    return models.evaluate_perceptron(train, test, "y", "features", 10, width)
