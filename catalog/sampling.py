"""Sampling, splits, top-up and sample quality."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.views import BASIC, KEYS, LAB, NUMERIC, digest_sql, emb, lab, li, registrar, rounded, table
from tabscope.operators import cluster_sampling, profile, quality, sampling

REGISTRY: dict = {}
query = registrar(REGISTRY)

STRATA = ["l_returnflag", "l_linestatus"]
LINE = f"{digest_sql(42, KEYS)}, {', '.join(KEYS)}"
DOC = f"{digest_sql(42, ['doc_id'])}, doc_id"


def _quotas(source: str, strata: list[str], size: int) -> str:
    keys = ", ".join(strata)
    return f"""counts AS (SELECT {keys}, count(*) AS count FROM {source} GROUP BY ALL),
targets AS (SELECT *, count / (SELECT sum(count) FROM counts) * {size} AS target FROM counts),
quotas AS (SELECT *, greatest(round(target), 2)::BIGINT AS needed,
  least(greatest(round(target), 2)::BIGINT, count) AS quota FROM targets)"""


STRATIFIED = f"""{_quotas('lineitem', STRATA, 1000)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY {', '.join(STRATA)} ORDER BY {LINE}) AS n FROM lineitem),
sample AS (SELECT ranked.* FROM ranked JOIN quotas USING ({', '.join(STRATA)}) WHERE n <= quota)"""


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").drop("l_shipdate")


@query(f"WITH {_quotas('lineitem', STRATA, 1000)} SELECT l_returnflag || '_' || l_linestatus AS stratum, count, round(target, 6) + 0.0 AS target, needed, quota FROM quotas")
def stratum_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotas = sampling.stratum_quotas(lineitem(spark, sf_dir), STRATA, 1000)
    named = quotas.select(sampling.stratum_key(STRATA).alias("stratum"), "count", "target", "needed", "quota")
    return rounded(named, 6, "target")


@query(f"WITH {STRATIFIED} SELECT * EXCLUDE (l_shipdate, n) FROM sample")
def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_sample(lineitem(spark, sf_dir), STRATA, KEYS, 1000, shuffled=True)


LAB_SAMPLE = f"""{LAB}, {_quotas('lab', ['cls'], 200)},
ranked AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY {DOC}) AS n FROM lab),
sample AS (SELECT lab.* FROM ranked lab JOIN quotas USING (cls) WHERE n <= quota)"""

TOP_UP_PLAN = f"""{LAB_SAMPLE},
have AS (SELECT cls, count(*) AS have FROM sample GROUP BY cls),
rare AS (SELECT *, 30 - have AS need FROM have WHERE have < 30),
plan AS (SELECT rare.*, available, CASE WHEN available > need THEN need ELSE available END AS from_original,
    CASE WHEN available > need THEN 0 ELSE need - available END AS copies
  FROM rare JOIN (SELECT cls, count(*) AS available FROM lab GROUP BY cls) USING (cls)),
most AS (SELECT cls, have FROM have ORDER BY have DESC, cls LIMIT 1),
added AS (SELECT coalesce(sum(from_original + copies), 0) AS total FROM plan),
possible AS (SELECT total > 0 AND (SELECT have FROM most) > total AS ok, total FROM added),
extra AS (
  SELECT * EXCLUDE (k, from_original) FROM (
    SELECT lab.*, from_original, row_number() OVER (PARTITION BY cls ORDER BY {digest_sql(43, ['doc_id'])}, doc_id) AS k
    FROM lab JOIN (SELECT cls, from_original FROM plan) USING (cls))
  WHERE k <= from_original AND (SELECT ok FROM possible)),
slots AS (SELECT cls, (slot - 1) % have + 1 AS k FROM (SELECT cls, have, unnest(range(1, copies + 1)) AS slot FROM plan)),
numbered AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY {digest_sql(44, ['doc_id'])}, doc_id) AS k FROM sample),
copied AS (SELECT numbered.* EXCLUDE (k) FROM numbered JOIN slots USING (cls, k) WHERE (SELECT ok FROM possible)),
trimmed AS (
  SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY {DOC}) AS k FROM sample)
  WHERE NOT ((SELECT ok FROM possible) AND cls = (SELECT cls FROM most) AND k <= (SELECT total FROM possible)))"""

LAB_COLUMNS = "doc_id, quality, toxic, n_chars, lang, source, cls"


@query(f"""WITH {TOP_UP_PLAN} SELECT cls, have, need, available, from_original, copies FROM plan""")
def top_up_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lab(spark, sf_dir)
    sample = sampling.stratified_sample(rows, ["cls"], ["doc_id"], 200)
    return sampling.top_up_plan(rows, sample, "cls")


@query(f"""WITH {TOP_UP_PLAN}
SELECT {LAB_COLUMNS} FROM trimmed UNION ALL SELECT {LAB_COLUMNS} FROM extra UNION ALL SELECT {LAB_COLUMNS} FROM copied""")
def rare_class_topup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.stratified_sample(lab(spark, sf_dir), ["cls"], ["doc_id"], 200, top_up="cls")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(concat_ws('_', '42', o_orderkey)), o_orderkey LIMIT 500")
def simple_random_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return sampling.simple_random_sample(orders, 500, ["o_orderkey"])


@query("""
SELECT * EXCLUDE (n, size) FROM (
  SELECT event_id, user_id, event_type, value,
    row_number() OVER (PARTITION BY event_type ORDER BY md5(concat_ws('_', '42', event_id)), event_id) AS n,
    count(*) OVER (PARTITION BY event_type) AS size
  FROM events)
WHERE n <= CASE WHEN size > 1500 THEN 400 ELSE size END""")
def presample_large_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return sampling.presample_large_groups(events, ["event_type"], ["event_id"], 1500, 400)


@query(f"""
WITH ranked AS (SELECT {', '.join(KEYS)}, l_quantity, row_number() OVER (ORDER BY {LINE}) AS n FROM lineitem)
SELECT * EXCLUDE (n), CASE WHEN n <= round(0.9 * (SELECT count(*) FROM lineitem)) THEN 'train' ELSE 'test' END AS split FROM ranked""")
def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.random_split(lineitem(spark, sf_dir).select(*KEYS, "l_quantity"), KEYS)


def _split(source: str, label: str, key: str, keep: str, rare: int) -> str:
    return f"""counts AS (SELECT {label} AS c, count(*) AS n FROM {source} GROUP BY ALL),
common AS (SELECT * FROM counts WHERE n > {rare}),
train AS (SELECT (sum(n) - ceil(sum(n) * 0.25))::BIGINT AS rows, sum(n) AS total FROM common),
shares AS (SELECT c, n, n * rows / total AS share, floor(n * rows / total) AS whole FROM common, train),
cuts AS (
  SELECT c, whole + CASE WHEN row_number() OVER (ORDER BY round(share - whole, 9) DESC, c)
    <= (SELECT rows FROM train) - (SELECT sum(whole) FROM shares) THEN 1 ELSE 0 END AS cut FROM shares
  UNION ALL SELECT c, 1 FROM counts WHERE n <= {rare}),
placed AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {digest_sql(42, [key])}, {key}) AS k FROM {source})
SELECT {keep}, CASE WHEN k <= cut THEN 'train' ELSE 'test' END AS split FROM placed JOIN cuts ON c = {label}"""


@query(f"WITH {_split('events', 'event_type', 'event_id', 'event_id, event_type', 0)}")
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return sampling.stratified_split(events, "event_type", ["event_id"])


@query(f"WITH {LAB}, {_split('lab', 'cls', 'doc_id', LAB_COLUMNS, 10)}")
def rare_aware_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.rare_aware_split(lab(spark, sf_dir), "cls", ["doc_id"], rare_rows=10)


@query(f"""
SELECT {', '.join(KEYS)}, l_returnflag,
  (ntile(5) OVER (PARTITION BY l_returnflag ORDER BY {LINE}) - 1)::INTEGER AS fold FROM lineitem""")
def stratified_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem(spark, sf_dir).select(*KEYS, "l_returnflag")
    return sampling.stratified_folds(rows, "l_returnflag", KEYS)


@query("""
WITH most AS (SELECT event_type FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1)
SELECT event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY md5(concat_ws('_', '42', event_id)), event_id) AS n FROM events)
WHERE event_type <> (FROM most) OR n > 700""")
def majority_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    top = sampling.most_common(profile.category_counts(events, ["event_type"]), "event_type")
    return sampling.trim_class(events, "event_type", top.withColumn("remove", F.lit(700)), ["event_id"])


@query("SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def missing_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    present = table(spark, sf_dir, "supplier").where(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("l_suppkey"))
    return sampling.missing_classes(lineitem(spark, sf_dir), present, "l_suppkey")


# The order priorities of one status against those of all orders, some of them absent.
QUALITY_SAMPLE = "sample AS (SELECT * FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority <> '5-LOW')"


def _comparison(target: str) -> str:
    return f"""
    SELECT '{target}' AS target, coalesce(a.c, b.c) AS class, coalesce(a.pct, 0) AS original_pct, coalesce(b.pct, 0) AS sample_pct
    FROM (SELECT {target} AS c, count(*) / (SELECT count(*) FROM orders) * 100 AS pct FROM orders GROUP BY 1) a
    FULL JOIN (SELECT {target} AS c, count(*) / (SELECT count(*) FROM sample) * 100 AS pct FROM sample GROUP BY 1) b ON a.c = b.c"""


TARGETS = ["o_orderstatus", "o_orderpriority"]
COMPARISON = f"""{QUALITY_SAMPLE}, compared AS ({' UNION ALL '.join(_comparison(t) for t in TARGETS)}),
similarity AS (SELECT target, round(avg(greatest(0, 100 - abs(original_pct - sample_pct))), 2) AS similarity FROM compared GROUP BY target)"""


def orders_and_sample(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", *TARGETS)
    return orders, orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") != "5-LOW"))


@query(f"WITH {COMPARISON} SELECT * FROM similarity")
def distribution_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distribution_similarity(*orders_and_sample(spark, sf_dir), TARGETS)


@query(f"""
WITH {COMPARISON}, sizes AS (SELECT (SELECT count(*) FROM orders) AS rows_before, (SELECT count(*) FROM sample) AS rows_after)
SELECT (SELECT round(avg(similarity), 2) FROM similarity) AS overall_quality, rows_before, rows_after,
  round((1 - rows_after / rows_before) * 100, 2) AS size_reduction FROM sizes""")
def overall_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.overall_quality(*orders_and_sample(spark, sf_dir), TARGETS)


@query(f"""
WITH {COMPARISON} SELECT target, substr(class, 1, 15) AS class, printf('%.1f%%', original_pct) AS original_pct,
  printf('%.1f%%', sample_pct) AS sample_pct FROM compared""")
def comparison_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.comparison_table(*orders_and_sample(spark, sf_dir), TARGETS)


CLUSTERED = """clustered AS (
  SELECT *, CASE WHEN l_linenumber <= 5 THEN 'c' || l_linenumber END AS cluster FROM lineitem)"""


@query("""
WITH counts AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
SELECT event_type, least(greatest(round(n / (SELECT sum(n) FROM counts) * 777), 1)::BIGINT, n) AS target FROM counts""")
def cluster_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_sampling.cluster_targets(table(spark, sf_dir, "events"), ["event_type"], 777)


@query(f"""
WITH {CLUSTERED}, sizes AS (SELECT l_returnflag, cluster, count(*) AS size FROM clustered GROUP BY ALL),
totals AS (SELECT l_returnflag, sum(size) AS rows FROM sizes GROUP BY 1),
targets AS (SELECT l_returnflag, rows, least(greatest(round(rows / (SELECT count(*) FROM lineitem) * 1000), 1)::BIGINT, rows) AS target FROM totals),
planned AS (SELECT *, CASE WHEN cluster IS NULL THEN size ELSE least(greatest(1, floor(size / rows * target)), size) END AS wanted
  FROM sizes JOIN targets USING (l_returnflag)),
used AS (SELECT *, coalesce(sum(wanted) OVER (PARTITION BY l_returnflag ORDER BY cluster NULLS LAST
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM planned)
SELECT l_returnflag, cluster, least(wanted, greatest(0, target - before))::BIGINT AS quota FROM used""")
def cluster_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber")
    clustered = lineitem(spark, sf_dir).withColumn("cluster", F.when(number <= 5, F.concat(F.lit("c"), number)))
    targets = cluster_sampling.cluster_targets(clustered, ["l_returnflag"], 1000)
    return cluster_sampling.density_quotas(clustered, targets, ["l_returnflag"])


@query("""
WITH m AS (SELECT l_returnflag, avg(l_quantity) AS mq, stddev_pop(l_quantity) AS sq, avg(l_tax) AS mt, stddev_pop(l_tax) AS st
  FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round((l_quantity - mq) / sq, 6) + 0.0 AS quantity,
  round((l_tax - mt) / st, 6) + 0.0 AS tax, 0::DOUBLE AS konst
FROM lineitem JOIN m USING (l_returnflag)""")
def scaled_by_stratum(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = ["l_quantity", "l_tax", "konst"]
    scaled = cluster_sampling.scaled_in_stratum(li(spark, sf_dir), ["l_returnflag"], features)
    wide = scaled.select(*KEYS, *[F.col("_x")[i].alias(n) for i, n in enumerate(("quantity", "tax", "konst"))])
    return rounded(wide, 6, "quantity", "tax", "konst")


@query()
def kmeans_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, features = emb(spark, sf_dir)
    sample = cluster_sampling.kmeans_sample(rows, ["label"], features, ["vec_id"], 100)
    return sample.select("vec_id", "label")


@query()
def density_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = [c for c in NUMERIC if c != "konst"]
    return cluster_sampling.density_sample(li(spark, sf_dir), ["label", "l_linestatus"], features, KEYS, 1000)


@query("""
WITH m AS (SELECT l_returnflag, l_linestatus, avg(l_quantity) AS mq, avg(l_discount) AS md FROM lineitem GROUP BY ALL),
d AS (SELECT l.*, round((l_quantity - mq) * (l_quantity - mq) + (l_discount - md) * (l_discount - md), 9) AS d
  FROM lineitem l JOIN m USING (l_returnflag, l_linestatus)),
r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus
  ORDER BY d, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS place FROM d)
SELECT l_returnflag, l_linestatus, l_orderkey, l_partkey, l_suppkey, l_linenumber FROM r WHERE place = 1""")
def nearest_to_centre(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lineitem(spark, sf_dir)
    return cluster_sampling.nearest_to_centre(rows, ["l_returnflag", "l_linestatus"], ["l_quantity", "l_discount"], KEYS)


def _grid_sql() -> str:
    moments = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(BASIC))
    cell = ", ".join(f"floor(round(({c} - m{i}) / s{i} / (3.49 / n ** (1.0 / {len(BASIC) + 2})), 9))::BIGINT" for i, c in enumerate(BASIC))
    close = " AND ".join(f"a.cell[{i + 1}] - b.cell[{i + 1}] BETWEEN -1 AND 1" for i in range(len(BASIC)))
    strata, keys = ", ".join(STRATA), ", ".join(KEYS)
    return f"""
WITH RECURSIVE moments AS (SELECT {strata}, count(*) AS n, {moments} FROM lineitem GROUP BY {strata}),
placed AS (SELECT {strata}, {keys}, n AS total, [{cell}] AS cell FROM lineitem JOIN moments USING ({strata})),
cells AS (SELECT {strata}, cell, total, count(*) AS n FROM placed GROUP BY ALL),
dense AS (SELECT *, array_to_string(cell, '_') AS name FROM cells
  JOIN (SELECT {strata}, avg(n) AS mean FROM cells GROUP BY ALL) USING ({strata}) WHERE n >= greatest(2, mean)),
touching AS (SELECT a.{STRATA[0]}, a.{STRATA[1]}, a.name AS a, b.name AS b FROM dense a JOIN dense b USING ({strata}) WHERE {close}),
reached AS (
  SELECT {strata}, name, name AS label FROM dense
  UNION
  SELECT {strata}, b, label FROM reached JOIN touching USING ({strata}) WHERE name = a),
labelled AS (SELECT {strata}, name, min(label) AS cluster FROM reached GROUP BY ALL),
assigned AS (SELECT * FROM dense JOIN labelled USING ({strata}, name)),
large AS (SELECT {strata}, cluster FROM assigned GROUP BY ALL HAVING sum(n) >= greatest(5, least(50, floor(any_value(total) / 100)))),
kept AS (SELECT {strata}, cell, cluster FROM assigned JOIN large USING ({strata}, cluster))
SELECT {strata}, {keys}, cluster FROM placed LEFT JOIN kept USING ({strata}, cell)"""


@query(_grid_sql())
def density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = cluster_sampling.scaled_in_stratum(lineitem(spark, sf_dir), STRATA, BASIC)
    return cluster_sampling.density_clusters(scored, STRATA, KEYS, turned=False)


@query("""
WITH v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
entries AS (SELECT vec_id, label, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM v),
centres AS (SELECT label AS cluster, i, avg(e) AS c FROM entries GROUP BY ALL),
far AS (SELECT vec_id, cluster, sum((e - c) * (e - c)) AS d FROM entries JOIN centres USING (i) GROUP BY ALL),
near AS (SELECT vec_id, arg_min(cluster, d) AS cluster, min(d) AS d FROM far GROUP BY vec_id),
moved AS (SELECT cluster, i, avg(e) AS c FROM entries JOIN near USING (vec_id) GROUP BY ALL)
SELECT cluster::INTEGER AS cluster, rows, round(cost, 6) AS cost, shift FROM
  (SELECT cluster, count(*) AS rows, sum(d) AS cost FROM near GROUP BY 1)
  JOIN (SELECT cluster, round(sum((m.c - o.c) * (m.c - o.c)), 6) + 0.0 AS shift FROM moved m JOIN centres o USING (cluster, i) GROUP BY 1) USING (cluster)""")
def kmeans_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step from given centres, the means of the labels: rows and cost of each cluster, and how far its centre moves."""
    rows, features = emb(spark, sf_dir)
    means = rows.groupBy("label").agg(*[F.avg(c).alias(c) for c in features]).orderBy("label").collect()
    labels = [r["label"] for r in means]
    centres = np.array([[[r[c] for c in features] for r in means]])
    points = rows.select(F.lit("all").alias("part"), F.array(*features).alias("x"))
    step = cluster_sampling.lloyd_step(points, {"all": centres})
    number = F.element_at(F.array(*[F.lit(v) for v in labels]), F.col("cluster") + 1).cast("int")
    old = F.element_at(F.lit(centres[0].tolist()), F.col("cluster") + 1)
    shift = F.aggregate(F.zip_with("centre", old, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return rounded(step.select(number.alias("cluster"), "rows", "cost", shift.alias("shift")), 6, "cost", "shift")


@query("""
WITH counts AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, least(greatest(round(n / (SELECT sum(n) FROM counts) * 100), 1)::BIGINT, n) AS medoids FROM counts""")
def kmeans_sample_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medoids of each label in the k-means sample: one for each cluster that its target asks for."""
    return kmeans_sample(spark, sf_dir).groupBy("label").agg(F.count(F.lit(1)).alias("medoids"))
