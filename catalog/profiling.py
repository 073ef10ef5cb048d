"""Describe, counts, histograms, box statistics and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.views import BASIC, GAPS, LI, NUMERIC, gaps, li, long_sql, registrar, rounded, table
from tabscope.operators import profile

REGISTRY: dict = {}
query = registrar(REGISTRY)

QUARTILES = """quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75"""

DESCRIBED = f"""{LI}, long AS ({long_sql('li', NUMERIC)}),
described AS (
  SELECT feature, count(value) AS count, count(*) - count(value) AS null_count, avg(value) AS mean,
    stddev_samp(value) AS std, min(value) AS min, {QUARTILES}, max(value) AS max
  FROM long GROUP BY feature)"""


@query(f"""
WITH {DESCRIBED},
texts AS (SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM li UNION ALL SELECT 'label', label FROM li)
SELECT feature, count, null_count, round(mean, 4) + 0.0 AS mean, round(std, 4) + 0.0 AS std, min,
  round(p25, 4) + 0.0 AS p25, round(p50, 4) + 0.0 AS p50, round(p75, 4) + 0.0 AS p75, max,
  NULL::VARCHAR AS min_text, NULL::VARCHAR AS max_text FROM (SELECT * REPLACE (round(min, 4) + 0.0 AS min, round(max, 4) + 0.0 AS max) FROM described)
UNION ALL
SELECT feature, count(value), count(*) - count(value), NULL, NULL, NULL, NULL, NULL, NULL, NULL, min(value), max(value)
FROM texts GROUP BY feature""")
def describe_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    described = profile.describe(li(spark, sf_dir), [*NUMERIC, "l_returnflag", "label"])
    return rounded(described, 4, "mean", "std", "min", "p25", "p50", "p75", "max")


@query(f"""
WITH {GAPS}
SELECT 'quantity' AS feature, count(*) - count(quantity) AS null_count FROM gaps
UNION ALL SELECT 'discount', count(*) - count(discount) FROM gaps
UNION ALL SELECT 'l_returnflag', count(*) - count(l_returnflag) FROM gaps""")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_counts(gaps(spark, sf_dir).select("quantity", "discount", "l_returnflag"))


@query("SELECT lang, source, count(*) AS count FROM documents GROUP BY ALL")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.category_counts(table(spark, sf_dir, "documents"), ["lang", "source"])


@query("""
SELECT event_type, count(*) AS count, round(count(*) / sum(count(*)) OVER () * 100, 6) + 0.0 AS percentage
FROM events GROUP BY event_type""")
def category_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.category_percentages(table(spark, sf_dir, "events"), ["event_type"]), 6, "percentage")


@query(f"""
WITH {LI}, long AS ({long_sql('li', NUMERIC)}), v AS (SELECT feature, var_samp(value) AS variance FROM long GROUP BY feature)
SELECT feature, round(variance, 4) + 0.0 AS variance, variance IS NULL OR abs(variance) < 1e-10 AS near_zero,
  coalesce(variance = 0, false) AS zero, variance IS NULL OR variance = 0 AS constant FROM v""")
def zero_variance_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.variances(li(spark, sf_dir), NUMERIC), 4, "variance")


@query(f"WITH {LI} SELECT * EXCLUDE (konst, l_shipdate) FROM li")
def remove_zero_variance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.remove_zero_variance_columns(li(spark, sf_dir), keep=["l_linenumber"])


def _histogram(by: str, clip: bool) -> str:
    """SQL from rows ``long`` (by, feature, value) on."""
    keys = f"{by}, feature" if by else "feature"
    bounded = (
        f"""upper AS (SELECT {keys}, quantile_cont(value, 0.99) AS upper FROM long GROUP BY ALL),
kept AS (SELECT long.* FROM long JOIN upper USING ({keys}) WHERE value <= upper),"""
        if clip
        else "kept AS (SELECT * FROM long),"
    )
    return f"""{bounded}
ends AS (SELECT {keys}, min(value) AS a, max(value) AS b, count(*) AS total FROM kept GROUP BY ALL),
edges AS (SELECT {keys}, total, CASE WHEN a = b THEN a - 0.5 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5 ELSE b END AS hi FROM ends),
counts AS (SELECT {keys}, least(floor((value - lo) / (hi - lo) * 50), 49)::INTEGER AS bin, count(*) AS count
  FROM kept JOIN edges USING ({keys}) GROUP BY ALL),
grid AS (SELECT edges.*, unnest(range(50))::INTEGER AS bin FROM edges)
SELECT {keys}, bin, round(lo + bin * ((hi - lo) / 50), 6) + 0.0 AS bin_start, coalesce(count, 0) AS count,
  round(coalesce(count, 0) / (total * ((hi - lo) / 50)), 9) + 0.0 AS density
FROM grid LEFT JOIN counts USING ({keys}, bin)"""


HISTOGRAM_FEATURES = [*BASIC, "konst"]


@query(f"WITH {LI}, long AS ({long_sql('li', HISTOGRAM_FEATURES)}), {_histogram('', True)}")
def histogram_clipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.histogram(li(spark, sf_dir), HISTOGRAM_FEATURES)
    return rounded(rounded(found, 6, "bin_start"), 9, "density")


@query(f"WITH long AS ({long_sql('events', ['value'], ['event_type'])}), {_histogram('event_type', False)}")
def histogram_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.histogram(table(spark, sf_dir, "events"), ["value"], ["event_type"])
    return rounded(rounded(found, 6, "bin_start"), 9, "density")


def _fences(by: str) -> str:
    keys = f"{by}, feature" if by else "feature"
    return f"""q AS (SELECT {keys}, {QUARTILES} FROM long GROUP BY ALL),
fences AS (SELECT *, p25 - (p75 - p25) * 1.5 AS low_fence, p75 + (p75 - p25) * 1.5 AS high_fence FROM q)"""


def _box(by: str) -> str:
    keys = f"{by}, feature" if by else "feature"
    return f"""{_fences(by)}
SELECT {keys}, count(*) AS count, round(any_value(p25), 6) + 0.0 AS p25, round(any_value(p50), 6) + 0.0 AS p50,
  round(any_value(p75), 6) + 0.0 AS p75,
  round(least(min(value) FILTER (value >= low_fence), any_value(p25)), 6) + 0.0 AS whisker_low,
  round(greatest(max(value) FILTER (value <= high_fence), any_value(p75)), 6) + 0.0 AS whisker_high,
  count(*) FILTER (value < low_fence OR value > high_fence) AS outliers
FROM long JOIN fences USING ({keys}) GROUP BY ALL"""


@query(f"WITH {LI}, long AS ({long_sql('li', NUMERIC)}), {_box('')}")
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.box_statistics(li(spark, sf_dir), NUMERIC)
    return rounded(found, 6, "p25", "p50", "p75", "whisker_low", "whisker_high")


@query(f"WITH long AS ({long_sql('events', ['value'], ['event_type'])}), {_box('event_type')}")
def box_stats_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profile.box_statistics(table(spark, sf_dir, "events"), ["value"], ["event_type"])
    return rounded(found, 6, "p25", "p50", "p75", "whisker_low", "whisker_high")


@query(f"""WITH long AS ({long_sql('events', ['value'], ['event_type'])}), {_fences('event_type')}
SELECT event_type, feature, value, count(*) AS count FROM long JOIN fences USING (event_type, feature)
WHERE NOT (value BETWEEN low_fence AND high_fence) GROUP BY ALL""")
def box_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.box_outliers(table(spark, sf_dir, "events"), ["value"], ["event_type"])


FLAGS = f"""{DESCRIBED}, flags AS (
SELECT feature,
  CASE WHEN mean = max AND mean = min THEN 'yes' ELSE 'no' END AS mean_max_min_equal,
  CASE WHEN abs(mean - p50) > std THEN 'large gap' ELSE 'small gap' END AS mean_median_gap,
  CASE WHEN std >= 0.5 * mean THEN 'yes' ELSE 'no' END AS large_std,
  CASE WHEN max > 5 * p50 THEN 'yes' ELSE 'no' END AS max_too_high,
  CASE WHEN max > p75 + 1.5 * (p75 - p25) AND min < p25 - 1.5 * (p75 - p25) THEN 'Both tails'
    WHEN max > p75 + 1.5 * (p75 - p25) THEN 'Right long-tailed'
    WHEN min < p25 - 1.5 * (p75 - p25) THEN 'Left long-tailed' ELSE 'Not long-tailed' END AS long_tail_check
FROM described)"""


@query(f"WITH {FLAGS} SELECT * FROM flags")
def distribution_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distribution_flags(profile.describe(li(spark, sf_dir), NUMERIC))


@query(f"WITH {FLAGS} SELECT feature FROM flags WHERE large_std = 'yes' OR max_too_high = 'yes'")
def problematic_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = profile.distribution_flags(profile.describe(li(spark, sf_dir), NUMERIC))
    return profile.problematic_features(flags)


@query("""
SELECT event_type, count(*) AS count,
  round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6) + 0.0 AS weight
FROM events GROUP BY event_type""")
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_weights(table(spark, sf_dir, "events"), "event_type"), 6, "weight")


@query(f"""
WITH {LI}, long AS ({long_sql('li', NUMERIC, ['label'])})
SELECT label, feature, round(avg(value), 4) + 0.0 AS mean, round(stddev_pop(value), 4) + 0.0 AS std, count(value) AS count
FROM long GROUP BY ALL""")
def class_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(profile.class_moments(li(spark, sf_dir), NUMERIC, "label"), 4, "mean", "std")




@query("""
WITH t AS (SELECT l_shipdate, l_quantity > 25 AS large FROM lineitem)
SELECT 'l_shipdate' AS feature, count(l_shipdate) AS count, count(*) - count(l_shipdate) AS null_count,
  strftime(min(l_shipdate), '%Y-%m-%d %H:%M:%S') AS min_text, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS max_text FROM t
UNION ALL SELECT 'large', count(large), count(*) - count(large), min(large)::VARCHAR, max(large)::VARCHAR FROM t""")
def describe_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_shipdate", (F.col("l_quantity") > 25).alias("large"))
    return profile.describe(rows).select("feature", "count", "null_count", "min_text", "max_text")
