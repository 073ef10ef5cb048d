"""Correlation, feature groups, representatives and label association."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.profiling import DESCRIBED, QUARTILES
from catalog.views import GAPS, LI, NUMERIC, gaps, li, long_sql, registrar, rounded, table
from tabscope.operators import association, correlate, profile, reduce, select
from tabscope.sources.tables import column_groups

REGISTRY: dict = {}
query = registrar(REGISTRY)

# Encoded label, the varying numeric columns, and the class rank, in the order of the matrix.
CODED = ["label", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc_price", "charge", "refund", "cls"]


def _matrix(source: str, features: list[str]) -> str:
    """SQL for a long correlation table of the given columns of ``source``."""
    pairs = [(i, j, a, b) for i, a in enumerate(features) for j, b in enumerate(features)]
    aggregates = ", ".join(f"corr({a}, {b}) AS r{i}_{j}" for i, j, a, b in pairs if i <= j)
    rows = " UNION ALL ".join(
        f"SELECT {i}::INTEGER AS position1, {j}::INTEGER AS position2, '{a}' AS feature1, '{b}' AS feature2, "
        f"r{min(i, j)}_{max(i, j)} AS r FROM aggregated"
        for i, j, a, b in pairs
    )
    return f"aggregated AS (SELECT {aggregates} FROM {source}), matrix AS ({rows})"


MATRIX = f"""{LI}, coded AS (
  SELECT CASE WHEN label = 'Benign' THEN 0 ELSE 1 END AS label, l_quantity, l_extendedprice, l_discount, l_tax,
    disc_price, charge, l_quantity - charge AS refund, dense_rank() OVER (ORDER BY l_linestatus) - 1 AS cls
  FROM li), {_matrix('coded', CODED)}"""

PAIRS = f"""{MATRIX}, pairs AS (
  SELECT feature1, feature2, round(r, 6) + 0.0 AS correlation FROM matrix
  WHERE position1 < position2 AND abs(r) > 0.7)"""


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as a labelled table: numeric columns, one constant, label and class."""
    return li(spark, sf_dir).select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc_price", "charge", "konst",
        (F.col("l_quantity") - F.col("charge")).alias("refund"), "label", F.col("l_linestatus").alias("cls"),
    )


def matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlate.feature_correlations(flows(spark, sf_dir), "label", "cls")


@query(f"WITH {MATRIX} SELECT feature1, feature2, position1, position2, round(r, 6) + 0.0 AS r FROM matrix")
def correlation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(matrix(spark, sf_dir), 6, "r")


PART_COLUMNS = ["p_partkey", "p_size", "p_retailprice"]


@query(f"WITH {_matrix('part', PART_COLUMNS)} SELECT feature1, feature2, round(r, 6) + 0.0 AS r FROM matrix")
def numeric_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("konst", F.lit(1.0))
    return rounded(correlate.numeric_correlations(part, ["konst"]), 6, "r").select("feature1", "feature2", "r")


SQUARE = ", ".join(
    f"max(round(r, 6) + 0.0) FILTER (feature2 = '{c}') AS {c}" for c in CODED
)


@query(f"WITH {MATRIX} SELECT feature1 AS feature, {SQUARE} FROM matrix GROUP BY feature1")
def correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlate.correlation_matrix(matrix(spark, sf_dir)), 6, *CODED)


@query(f"WITH {PAIRS} SELECT * FROM pairs")
def high_corr_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlate.high_correlation_pairs(matrix(spark, sf_dir)), 6, "correlation")


@query(f"""
WITH {MATRIX}
(SELECT 'positive' AS side, feature1, feature2, round(r, 6) + 0.0 AS r FROM matrix
 WHERE position1 < position2 AND r > 0.8 ORDER BY matrix.r DESC LIMIT 20)
UNION ALL
(SELECT 'negative', feature1, feature2, round(r, 6) + 0.0 FROM matrix
 WHERE position1 < position2 AND r < -0.8 ORDER BY matrix.r LIMIT 20)""")
def top_signed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix(spark, sf_dir)
    positive = correlate.top_pairs(long, 1).select(F.lit("positive").alias("side"), "*")
    negative = correlate.top_pairs(long, -1).select(F.lit("negative").alias("side"), "*")
    return rounded(positive.unionByName(negative), 6, "r")


CLUSTERS = f"""{MATRIX}, near AS (
  SELECT position1 AS i, list(position2 ORDER BY position2) AS others FROM matrix
  WHERE position1 <> position2 AND abs(r) > 0.9 GROUP BY position1),
walk AS (
  SELECT -1 AS i, []::INTEGER[] AS taken, NULL::INTEGER[] AS members
  UNION ALL
  SELECT walk.i + 1,
    CASE WHEN near.i IS NULL OR list_contains(taken, walk.i + 1) THEN taken
      ELSE list_concat(list_concat(taken, [walk.i + 1]), near.others) END,
    CASE WHEN near.i IS NULL OR list_contains(taken, walk.i + 1) THEN NULL
      ELSE list_concat([walk.i + 1], near.others) END
  FROM walk LEFT JOIN near ON near.i = walk.i + 1
  WHERE walk.i + 1 < {len(CODED)}),
numbered AS (SELECT row_number() OVER (ORDER BY i) - 1 AS cluster, members FROM walk WHERE members IS NOT NULL),
unfolded AS (SELECT cluster, unnest(members) AS p, generate_subscripts(members, 1) - 1 AS position FROM numbered),
clusters AS (
  SELECT DISTINCT cluster::INTEGER AS cluster, position::INTEGER AS position, feature1 AS feature
  FROM unfolded JOIN matrix ON position1 = p)"""


@query(f"WITH RECURSIVE {CLUSTERS} SELECT * FROM clusters")
def greedy_feature_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correlate.greedy_clusters(matrix(spark, sf_dir))


@query(f"""
WITH RECURSIVE {CLUSTERS},
kept AS (
  SELECT feature1 AS feature FROM matrix WHERE position1 = position2 AND (
    feature1 IN (SELECT feature FROM clusters WHERE position = 0) OR feature1 NOT IN (SELECT feature FROM clusters)))
SELECT feature1, feature2, round(r, 6) + 0.0 AS r FROM matrix
WHERE feature1 IN (FROM kept) AND feature2 IN (FROM kept)
  AND (SELECT count(*) FROM kept) BETWEEN 6 AND {len(CODED) - 1}""")
def reduced_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix(spark, sf_dir)
    reduced = correlate.reduced_matrix(long, correlate.greedy_clusters(long))
    return rounded(reduced.select("feature1", "feature2", "r"), 6, "r")


PART_CODED = ["label", *PART_COLUMNS, "p_type"]


@query(f"""
WITH coded AS (
  SELECT CASE WHEN p_size > 25 THEN 1 ELSE 0 END AS label, p_partkey, p_size, p_retailprice,
    dense_rank() OVER (ORDER BY p_type) - 1 AS p_type FROM part), {_matrix('coded', PART_CODED)}
SELECT feature2 AS feature, round(r, 6) + 0.0 AS r FROM matrix
WHERE feature1 = 'label' AND feature2 <> 'label' AND NOT isnan(r) AND abs(r) > 0.15""")
def label_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("p_size") > 25, "large").otherwise("Benign").alias("label")
    part = table(spark, sf_dir, "part").select(*PART_COLUMNS, label, "p_type")
    long = correlate.feature_correlations(part, "label", "p_type")
    return rounded(correlate.significant_for_label(long, "label"), 6, "r")


GROUPS = f"""{PAIRS},
links AS (SELECT feature1 AS a, feature2 AS b FROM pairs WHERE correlation >= 0.7
  UNION SELECT feature2, feature1 FROM pairs WHERE correlation >= 0.7),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
components AS (SELECT a AS feature, least(a, min(b)) AS "group" FROM reach GROUP BY a)"""


@query(f"WITH RECURSIVE {GROUPS} SELECT * FROM components")
def correlation_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select.correlation_groups(correlate.high_correlation_pairs(matrix(spark, sf_dir)))


REPRESENTATIVES = f"""{GROUPS},
scores AS (SELECT feature2 AS feature, sum(abs(r)) AS score FROM matrix
  WHERE feature1 IN ('label', 'cls') AND feature2 NOT IN ('label', 'cls') GROUP BY feature2),
ranked AS (SELECT components.*, row_number() OVER (PARTITION BY "group" ORDER BY round(coalesce(score, 0), 9) DESC, components.feature) AS n
  FROM components LEFT JOIN scores ON components.feature = scores.feature WHERE components.feature NOT IN ('label', 'cls')),
kept AS (SELECT "group", feature AS kept_feature FROM ranked WHERE n = 1)"""


@query(f"WITH RECURSIVE {REPRESENTATIVES} SELECT * FROM kept")
def group_representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix(spark, sf_dir)
    groups = select.correlation_groups(correlate.high_correlation_pairs(long))
    targets = ["label", "cls"]
    return select.group_representatives(groups, select.target_scores(long, targets), targets)


@query(f"""
WITH RECURSIVE {REPRESENTATIVES},
features AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'disc_price', 'charge', 'refund', 'label', 'cls']) AS feature)
SELECT f.feature, CASE WHEN k.kept_feature IS NULL OR k.kept_feature = f.feature THEN 'selected' ELSE 'dropped' END AS status,
  coalesce(k.kept_feature, f.feature) AS kept_feature
FROM features f LEFT JOIN components c ON c.feature = f.feature LEFT JOIN kept k ON k."group" = c."group" """)
def feature_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = matrix(spark, sf_dir)
    targets = ["label", "cls"]
    pairs = correlate.high_correlation_pairs(long)
    scores = select.target_scores(long, targets)
    return select.feature_selection(flows(spark, sf_dir), pairs, scores, targets, drop=["konst"])


STATISTICS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Describe rows of the line items and of the signed account balances."""
    balances = profile.describe(table(spark, sf_dir, "customer"), ["c_acctbal"])
    return profile.describe(li(spark, sf_dir), NUMERIC).unionByName(balances)


BOTH = f"""{DESCRIBED}, both_described AS (
  SELECT * FROM described UNION ALL
  SELECT 'c_acctbal', count(value), count(*) - count(value), avg(value), stddev_samp(value), min(value), {QUARTILES}, max(value)
  FROM (SELECT c_acctbal AS value FROM customer))"""


def _pairwise(statistics: list[str], source: str, by: str = "") -> str:
    key = f"{by}, " if by else ""
    rows = " UNION ALL ".join(
        f"SELECT {key}'{a}' AS statistic1, '{b}' AS statistic2, corr({a}, {b}) AS r FROM {source}"
        + (f" GROUP BY {by}" if by else "")
        for a in statistics
        for b in statistics
    )
    return f"SELECT {key}statistic1, statistic2, CASE WHEN isnan(r) THEN NULL ELSE round(r, 6) + 0.0 END AS r FROM ({rows})"


@query(f"WITH {BOTH} {_pairwise(STATISTICS, 'both_described')}")
def stat_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlate.statistic_correlation(both(spark, sf_dir)), 6, "r")


FEATURE_GROUPS = {
    "money": ["l_extendedprice", "disc_price", "charge", "c_acctbal", "unknown"],
    "rates": ["l_discount", "l_tax", "l_quantity"],
    "lonely": ["konst"],
}
GROUP_ROWS = " UNION ALL ".join(
    f"SELECT '{g}' AS grp, '{f}' AS feature" for g, features in FEATURE_GROUPS.items() for f in features
)


@query(f"""
WITH {BOTH}, groups AS ({GROUP_ROWS}),
members AS (SELECT grp AS "group", both_described.* FROM groups JOIN both_described USING (feature)),
large AS (SELECT * FROM members WHERE "group" IN (SELECT "group" FROM members GROUP BY 1 HAVING count(*) >= 2))
{_pairwise(STATISTICS, 'large', '"group"')}""")
def stat_correlation_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = column_groups(spark, FEATURE_GROUPS)
    return rounded(correlate.statistic_correlation_by_group(both(spark, sf_dir), groups, "label"), 6, "r")


@query(f"""
WITH {BOTH}, nine AS (
  SELECT feature, unnest([count, null_count, mean, std, min, p25, p50, p75, max]::DOUBLE[]) AS value FROM both_described),
summary AS (SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max FROM nine GROUP BY feature)
{_pairwise(['mean', 'std', 'min', 'max'], 'summary')}""")
def aggregate_stat_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlate.aggregate_statistic_correlation(both(spark, sf_dir)), 6, "r")


VARYING = [c for c in NUMERIC if c != "konst"]


@query(f"""
WITH {LI}, {_matrix('li', VARYING)}, groups AS ({GROUP_ROWS})
SELECT a.grp AS "group", feature1, feature2, round(r, 6) + 0.0 AS r
FROM matrix JOIN groups a ON a.feature = feature1 JOIN groups b ON b.feature = feature2 AND a.grp = b.grp""")
def group_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = column_groups(spark, FEATURE_GROUPS)
    return rounded(correlate.group_correlation(li(spark, sf_dir), groups), 6, "r")


def _moments(source: str, features: list[str], label: str) -> str:
    return f"""long AS ({long_sql(source, features, [label])}),
moments AS (
  SELECT feature, count(*) AS n, count(*) FILTER (y = 0) AS n0, count(*) FILTER (y = 1) AS n1,
    avg(value) FILTER (y = 0) AS m0, avg(value) FILTER (y = 1) AS m1,
    var_samp(value) FILTER (y = 0) AS v0, var_samp(value) FILTER (y = 1) AS v1,
    stddev_pop(value) FILTER (y = 0) AS s0, stddev_pop(value) FILTER (y = 1) AS s1,
    CASE WHEN stddev_pop(value) = 0 THEN NULL ELSE corr(value, y) END AS r
  FROM long WHERE value IS NOT NULL AND y IS NOT NULL GROUP BY feature
  HAVING count(*) >= 10 AND count(*) FILTER (y = 0) > 0 AND count(*) FILTER (y = 1) > 0),
measured AS (SELECT *, sqrt(((n0 - 1) * s0 ** 2 + (n1 - 1) * s1 ** 2) / (n0 + n1 - 2)) AS pooled FROM moments)"""


ASSOCIATION = f"""{LI}, lab AS (SELECT *, CASE label WHEN 'Benign' THEN 0 ELSE 1 END AS y FROM li),
{_moments('lab', NUMERIC, 'y')},
plain AS (
  SELECT feature, CASE WHEN isnan(r) THEN NULL ELSE round(r, 4) + 0.0 END AS point_biserial_corr,
    round(abs(m0 - m1), 4) + 0.0 AS mean_diff,
    round(CASE WHEN pooled > 0 THEN abs(m0 - m1) / pooled ELSE 0 END, 4) + 0.0 AS cohens_d,
    round(m0, 4) + 0.0 AS benign_mean, round(m1, 4) + 0.0 AS malicious_mean,
    round(s0, 4) + 0.0 AS benign_std, round(s1, 4) + 0.0 AS malicious_std, n0 AS benign_count, n1 AS malicious_count
  FROM measured)"""


@query(f"WITH {ASSOCIATION} SELECT * FROM plain")
def feature_label_association(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = association.feature_label_association(li(spark, sf_dir), NUMERIC, "label", pvalues=False)
    return rounded(found, 4, "point_biserial_corr")


# The t density turned into powers of a cosine by t = sqrt(df) tan(a), integrated by Simpson's rule.
STEPS = 20000
PVALUES = f"""{ASSOCIATION},
tests AS (
  SELECT feature, 'corr' AS test, r * sqrt((n - 2) / (1 - r ** 2)) AS t, (n - 2)::DOUBLE AS df FROM measured
  UNION ALL
  SELECT feature, 'welch', (m0 - m1) / nullif(sqrt(v0 / n0 + v1 / n1), 0),
    (v0 / n0 + v1 / n1) ** 2 / nullif((v0 / n0) ** 2 / (n0 - 1) + (v1 / n1) ** 2 / (n1 - 1), 0) FROM measured),
points AS (
  SELECT feature, test, df, i, atan(abs(t) / sqrt(df)) AS edge, CASE WHEN i IN (0, {STEPS}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w
  FROM tests, range({STEPS} + 1) steps(i) WHERE t IS NOT NULL AND NOT isnan(t)),
integrals AS (
  SELECT feature, test, any_value(df) AS df, sum(w * cos(edge * i / {STEPS}) ** (df - 1)) * any_value(edge) / {STEPS} / 3 AS area
  FROM points GROUP BY feature, test),
p AS (SELECT feature, test, greatest(0, 1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi()) * area) AS p FROM integrals),
tested AS (
  SELECT plain.*, round(c.p, 6) + 0.0 AS corr_p_value, round(w.p, 6) + 0.0 AS t_test_p_value
  FROM plain LEFT JOIN p c ON c.feature = plain.feature AND c.test = 'corr'
  LEFT JOIN p w ON w.feature = plain.feature AND w.test = 'welch')"""


@query(f"WITH {PVALUES} SELECT feature, corr_p_value, t_test_p_value FROM tested")
def feature_label_pvalues(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = association.feature_label_association(li(spark, sf_dir), NUMERIC, "label")
    return rounded(found.select("feature", "corr_p_value", "t_test_p_value"), 6, "corr_p_value", "t_test_p_value")


@query(f"""
WITH {PVALUES}
SELECT feature, point_biserial_corr, CASE WHEN corr_p_value < 0.001 THEN '***' WHEN corr_p_value < 0.01 THEN '**'
  WHEN corr_p_value < 0.05 THEN '*' ELSE '' END AS stars
FROM tested ORDER BY abs(point_biserial_corr) DESC NULLS LAST, feature LIMIT 5""")
def importance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = association.feature_label_association(li(spark, sf_dir), NUMERIC, "label")
    return rounded(association.importance_table(found, 5), 4, "point_biserial_corr")


@query(f"""
WITH {PVALUES}
SELECT count(*) AS analyzed, count(*) FILTER (abs(point_biserial_corr) > 0.3) AS strong,
  count(*) FILTER (abs(point_biserial_corr) > 0.1 AND abs(point_biserial_corr) <= 0.3) AS moderate,
  count(*) FILTER (corr_p_value < 0.05) AS significant FROM tested""")
def association_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = association.feature_label_association(li(spark, sf_dir), NUMERIC, "label")
    return association.association_summary(found)


@query(f"""
WITH {ASSOCIATION} SELECT feature, point_biserial_corr FROM plain
ORDER BY abs(point_biserial_corr) DESC NULLS LAST, feature LIMIT 3""")
def top_n_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = association.feature_label_association(li(spark, sf_dir), NUMERIC, "label", pvalues=False)
    return rounded(association.top_features(found, 3).select("feature", "point_biserial_corr"), 4, "point_biserial_corr")


@query(f"""
WITH {GAPS}, lab AS (
  SELECT quantity, CASE WHEN l_linenumber = 2 AND l_orderkey < 5 THEN quantity END AS scarce,
    CASE WHEN l_returnflag = 'R' THEN quantity END AS one_sided,
    CASE l_returnflag WHEN 'A' THEN 0 WHEN 'R' THEN 1 END AS y FROM gaps),
{_moments('lab', ['quantity', 'scarce', 'one_sided'], 'y')}
SELECT feature, n, n0, n1, round(m0, 6) + 0.0 AS mean0, round(m1, 6) + 0.0 AS mean1 FROM moments""")
def not_null_min_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gaps(spark, sf_dir).select(
        "quantity", "l_returnflag",
        F.when((F.col("l_linenumber") == 2) & (F.col("l_orderkey") < 5), F.col("quantity")).alias("scarce"),
        F.when(F.col("l_returnflag") == "R", F.col("quantity")).alias("one_sided"),
    )
    found = association.label_moments(rows, ["quantity", "scarce", "one_sided"], "l_returnflag", "A", "R")
    return rounded(found.select("feature", "n", "n0", "n1", "mean0", "mean1"), 6, "mean0", "mean1")


@query()
def pca_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flows(spark, sf_dir)
    original = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc_price", "charge", "konst", "refund"]
    return reduce.pca_variance(rows, original, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "refund"])


@query()
def pca_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce.pca_summary(pca_variance(spark, sf_dir), 8, 5)


EDGES = f"""{LI}, edges AS (
  SELECT CASE label WHEN 'Benign' THEN 0 ELSE 1 END AS y, CASE label WHEN 'Benign' THEN 0 ELSE 1 END::DOUBLE AS twin,
    CASE label WHEN 'Benign' THEN 5 ELSE -5 END::DOUBLE AS mirror, 3.0::DOUBLE AS steady FROM li)"""


# A feature that is the label, one that is its opposite (both constant on each side) and one that never varies.
@query(f"""
WITH {EDGES}
SELECT 'twin' AS feature, round(corr(twin, y), 4) + 0.0 AS point_biserial_corr, 0.0::DOUBLE AS corr_p_value, 0.0::DOUBLE AS t_test_p_value FROM edges
UNION ALL SELECT 'mirror', round(corr(mirror, y), 4) + 0.0, 0.0, 0.0 FROM edges
UNION ALL SELECT 'steady', NULL, NULL, NULL""")
def association_perfect(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.when(F.col("label") == "Benign", 0).otherwise(1)
    edges = li(spark, sf_dir).select(
        "label", y.cast("double").alias("twin"), (5.0 - 10.0 * y).alias("mirror"), F.lit(3.0).alias("steady")
    )
    found = association.feature_label_association(edges, ["twin", "mirror", "steady"], "label")
    names = ["point_biserial_corr", "corr_p_value", "t_test_p_value"]
    return rounded(found.select("feature", *names), 6, *names)


HOLED = ["quantity", "tax", "price"]
HOLES = """holes AS (SELECT CASE WHEN l_linenumber <> 1 THEN l_quantity END AS quantity,
  CASE WHEN l_linenumber <> 2 THEN l_tax END AS tax, l_extendedprice AS price FROM lineitem)"""


def holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        F.when(n != 1, F.col("l_quantity")).alias("quantity"), F.when(n != 2, F.col("l_tax")).alias("tax"),
        F.col("l_extendedprice").alias("price"), "l_linenumber",
    )


@query(f"""
WITH {HOLES}, complete AS (SELECT * FROM holes WHERE quantity IS NOT NULL AND tax IS NOT NULL), {_matrix("complete", HOLED)}
SELECT * REPLACE (round(r, 6) + 0.0 AS r) FROM matrix""")
def correlation_gaps_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlate.correlation_long(holes(spark, sf_dir), HOLED), 6, "r")


@query(f"""
WITH {HOLES}, complete AS (SELECT coalesce(quantity, 0) AS quantity, coalesce(tax, 0) AS tax, price FROM holes), {_matrix("complete", HOLED)}
SELECT * REPLACE (round(r, 6) + 0.0 AS r) FROM matrix""")
def correlation_gaps_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlate.correlation_long(holes(spark, sf_dir), HOLED, missing="zero"), 6, "r")


# No row is complete, so no r is defined.
@query("""
SELECT a.f AS feature1, b.f AS feature2, a.p AS position1, b.p AS position2, NULL::DOUBLE AS r
FROM (SELECT unnest(['quantity', 'tax']) AS f, unnest([0, 1]) AS p) a, (SELECT unnest(['quantity', 'tax']) AS f, unnest([0, 1]) AS p) b
WHERE (SELECT count(*) FROM lineitem) > 0""")
def correlation_without_complete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    apart = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_linenumber") % 2 == 1, F.col("l_tax")).alias("tax"),
    )
    return correlate.correlation_long(apart, ["quantity", "tax"])


REDUCED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _power_sums(dataset: str, names: list[str]) -> str:
    of = ", ".join(f"'{n}'" for n in names)
    return f"""SELECT '{dataset}' AS dataset, {len(names)}::BIGINT AS components, 1.0::DOUBLE * {len(names)} AS first,
  (SELECT sum(r * r) FROM matrix WHERE feature1 IN ({of}) AND feature2 IN ({of})) AS second,
  (SELECT sum(a.r * b.r * c.r) FROM matrix a JOIN matrix b ON a.feature2 = b.feature1
    JOIN matrix c ON b.feature2 = c.feature1 AND c.feature2 = a.feature1
    WHERE a.feature1 IN ({of}) AND a.feature2 IN ({of}) AND b.feature2 IN ({of})) AS third"""


# The eigenvalues of a correlation matrix R are fixed by the traces of R, R^2, ...: here the first three.
@query(f"""
WITH {LI}, {_matrix("li", [*REDUCED, "disc_price", "charge"])},
sums AS ({_power_sums("original", [*REDUCED, "disc_price", "charge"])} UNION ALL {_power_sums("reduced", REDUCED)})
SELECT dataset, components, round(first, 6) + 0.0 AS first, round(second, 6) + 0.0 AS second, round(third, 6) + 0.0 AS third FROM sums""")
def pca_power_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = reduce.pca_variance(li(spark, sf_dir), [*REDUCED, "disc_price", "charge"], REDUCED)
    counted = found.groupBy("dataset").agg(F.count("component").alias("components"), F.collect_list("explained").alias("shares"))
    eigen = F.transform("shares", lambda x: x * F.col("components"))
    power = lambda k: F.aggregate(eigen, F.lit(0.0), lambda s, x: s + F.pow(x, F.lit(float(k))))
    sums = counted.select("dataset", "components", power(1).alias("first"), power(2).alias("second"), power(3).alias("third"))
    return rounded(sums, 6, "first", "second", "third")


@query(f"""
WITH RECURSIVE {REPRESENTATIVES},
features AS (SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'disc_price', 'charge', 'refund', 'label', 'cls']) AS feature),
chosen AS (SELECT f.feature FROM features f LEFT JOIN components c ON c.feature = f.feature LEFT JOIN kept k ON k."group" = c."group"
  WHERE k.kept_feature IS NULL OR k.kept_feature = f.feature)
SELECT f.feature, CASE WHEN f.feature IN (SELECT feature FROM chosen) THEN (SELECT count(*) FROM li) ELSE 0 END AS rows FROM features f""")
def project_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values each column has in the table projected on the selected ones."""
    rows, names = flows(spark, sf_dir), ["label", "cls"]
    long = matrix(spark, sf_dir)
    pairs = correlate.high_correlation_pairs(long)
    chosen = select.feature_selection(rows, pairs, select.target_scores(long, names), names, drop=["konst"])
    projected = rows.select(*select.selected_columns(rows, chosen))
    counts = [(F.count(c) if c in projected.columns else F.lit(0).cast("long")).alias(c) for c in rows.columns if c != "konst"]
    return projected.agg(*counts).unpivot([], [c for c in rows.columns if c != "konst"], "feature", "rows")
