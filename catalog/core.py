"""Sources, sinks, projections, predicates and scalar encodings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.views import GAPS, KEYS, PORTS, gaps, ports, registrar, rounded, table
from tabscope.functions import scalars
from tabscope.operators import columns
from tabscope.session import scratch_path
from tabscope.sources import sinks, tables

REGISTRY: dict = {}
query = registrar(REGISTRY)


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_returnflag FROM lineitem")
def load_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lineitem")
    wanted = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_returnflag"]
    sinks.write_parquet(tables.read_columns(spark, f"{sf_dir}/lineitem.parquet", wanted), f"{path}.parquet")
    return tables.load_table(spark, path)


@query("SELECT * FROM customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "customer")
    customer = table(spark, sf_dir, "customer")
    sinks.write_csv(customer, f"{path}.csv")
    return tables.load_table(spark, path, customer.schema)


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def tsv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "supplier")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    sinks.write_tsv(supplier, path, single=False)
    return tables.read_csv(spark, path, supplier.schema, sep="\t")


@query("""
SELECT p_type || ': ' || string_agg(p_brand, ', ' ORDER BY p_brand) AS value
FROM (SELECT DISTINCT p_type, p_brand FROM part) GROUP BY p_type""")
def text_report_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "report")
    members = table(spark, sf_dir, "part").select(F.col("p_type").alias("group"), F.col("p_brand").alias("feature"))
    sinks.write_lines(sinks.group_lines(members.distinct()), path)
    return spark.read.text(path)


@query("""
SELECT o_orderpriority AS dataset, metric, round(value, 4) + 0.0 AS value
FROM (SELECT o_orderpriority, avg(o_totalprice) AS mean, max(o_totalprice) AS highest FROM orders GROUP BY 1)
UNPIVOT (value FOR metric IN (mean, highest))""")
def json_metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "metrics")
    wide = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("dataset")).agg(
        F.avg("o_totalprice").alias("mean"), F.max("o_totalprice").alias("highest")
    )
    metrics = wide.unpivot(["dataset"], ["mean", "highest"], "metric", "value")
    sinks.write_metrics_json(metrics, path, by=("dataset",))
    back = spark.read.schema("dataset string, metrics map<string,double>").json(path)
    return rounded(back.select("dataset", F.explode("metrics").alias("metric", "value")), 4, "value")


@query('SELECT DISTINCT p_type AS "group", p_brand AS feature FROM part')
def column_groups_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "groups")
    grouped = table(spark, sf_dir, "part").groupBy("p_type").agg(F.array_sort(F.collect_set("p_brand")).alias("m"))
    config = grouped.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("p_type", "m")))).alias("value"))
    sinks.write_lines(config, path)
    return tables.read_column_groups(spark, path)


@query("""
SELECT (row_number() OVER () - 1)::INTEGER AS position, column_name AS "column",
  column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') AS is_numeric
FROM (DESCRIBE lineitem)""")
def numeric_columns_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.column_listing(table(spark, sf_dir, "lineitem")).drop("dtype")


@query(f"""
WITH {GAPS}, types AS (SELECT (row_number() OVER () - 1)::INTEGER AS position, column_name AS "column", column_type AS t
  FROM (DESCRIBE SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity AS quantity, l_discount AS discount FROM lineitem)),
counts AS ({" UNION ALL ".join(f"SELECT '{c}' AS c, count({c}) AS present FROM gaps" for c in [*KEYS, "l_returnflag", "quantity", "discount"])})
SELECT position, "column", CASE t WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' ELSE 'string' END AS dtype,
  t <> 'VARCHAR' AS is_numeric, present FROM types JOIN counts ON c = "column\"""")
def column_listing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.present_counts(gaps(spark, sf_dir))


@query("SELECT * EXCLUDE (l_shipdate, l_linestatus) FROM lineitem")
def drop_named_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.drop_columns(table(spark, sf_dir, "lineitem"), ["l_shipdate", "l_linestatus", "no_such_column"])


@query("""
SELECT p_partkey, label,
  trim(regexp_replace(regexp_replace(label, '[<>:"/\\\\|?*() ]', '_', 'g'), '_+', '_', 'g'), '_') AS safe,
  regexp_replace(label, '[ /\\\\]', '_', 'g') AS path
FROM (SELECT p_partkey, ' ' || p_name || '/s (' || p_brand || ': ' || p_type || ') ' AS label FROM part)""")
def sanitize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(
        F.lit(" "), F.col("p_name"), F.lit("/s ("), F.col("p_brand"), F.lit(": "), F.col("p_type"), F.lit(") ")
    )
    named = table(spark, sf_dir, "part").select("p_partkey", label.alias("label"))
    return named.select(
        "*", scalars.sanitize_name(F.col("label")).alias("safe"), scalars.sanitize_path(F.col("label")).alias("path")
    )


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END AS code FROM lineitem")
def label_encode_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = scalars.encode_label(F.col("l_returnflag"), "A").alias("code")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", code)


@query("""
SELECT l_orderkey, word, CASE WHEN lower(word) IN ('benign', 'normal') THEN 0 ELSE 1 END AS from_text,
  CASE WHEN l_linenumber - 1 = 0 THEN 0 ELSE 1 END AS from_number
FROM (SELECT *, CASE l_returnflag WHEN 'A' THEN 'Benign' WHEN 'N' THEN 'NORMAL' ELSE 'Attack' END AS word
  FROM lineitem)""")
def label_encode_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    word = F.when(flag == "A", "Benign").when(flag == "N", "NORMAL").otherwise("Attack").alias("word")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", word).select(
        "l_orderkey", "word",
        scalars.encode_label_tolerant(F.col("word"), numeric=False).alias("from_text"),
        scalars.encode_label_tolerant(F.col("l_linenumber") - 1, numeric=True).alias("from_number"),
    )


@query("""
SELECT l_orderkey, l_returnflag, CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 END AS code FROM lineitem""")
def label_map_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = scalars.encode_label_strict(F.col("l_returnflag"), {"R": 1, "A": 0}).alias("code")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", code)


@query("SELECT doc_id, source, dense_rank() OVER (ORDER BY source) - 1 AS code FROM documents")
def dictionary_rank_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.dictionary_encode(table(spark, sf_dir, "documents").select("doc_id", "source"), "source")


@query("SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def label_domain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.unexpected_labels(table(spark, sf_dir, "events"), "event_type", ["click", "view"])


@query(f"""
WITH {GAPS}
SELECT l_orderkey, l_linenumber, coalesce(quantity, 0) AS filled,
  CASE WHEN discount IS NULL OR isnan(discount) THEN 0 ELSE discount END AS filled_discount,
  CASE WHEN discount IS NULL THEN NULL WHEN isnan(discount) THEN 0
    ELSE greatest(least(discount, 1.7976931348623157e308::DOUBLE), -1.7976931348623157e308::DOUBLE) END AS clean
FROM gaps""")
def null_fill_and_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gaps(spark, sf_dir)
    filled = columns.fill_numeric(rows.withColumn("clean", F.col("discount")), ["quantity", "discount"])
    # A missing value stays missing when only NaN and infinities are cleaned.
    cleaned = columns.clean_numeric(filled, ["clean"])
    return cleaned.select(
        "l_orderkey", "l_linenumber", F.col("quantity").alias("filled"), F.col("discount").alias("filled_discount"),
        F.col("clean"),
    )


@query("""
SELECT 'p_name' AS "column", count(*) FILTER (p_name IS NOT NULL AND try_cast(p_name AS DOUBLE) IS NULL) = 0 AS castable FROM part
UNION ALL
SELECT 'p_size', count(*) FILTER (p_size IS NOT NULL AND try_cast(p_size AS DOUBLE) IS NULL) = 0 FROM part
UNION ALL
SELECT 'digits', count(*) FILTER (try_cast(substr(p_brand, 7) AS DOUBLE) IS NULL) = 0 FROM part""")
def castable_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").withColumn("digits", F.expr("substr(p_brand, 7)"))
    return columns.castable_columns(part, ["p_name", "p_size", "digits"])


def _rich(port: str) -> str:
    return f"""
  ({port} <= 1023)::INTEGER AS {port}_well_known,
  ({port} > 1023 AND {port} <= 49151)::INTEGER AS {port}_registered,
  ({port} > 49151)::INTEGER AS {port}_dynamic,
  ({port} IN (80, 443, 8080, 8443))::INTEGER AS {port}_web,
  ({port} IN (25, 465, 587, 110, 143, 993, 995))::INTEGER AS {port}_email,
  ({port} IN (20, 21, 22, 69))::INTEGER AS {port}_file_transfer,
  ({port} IN (53))::INTEGER AS {port}_dns"""


@query(f"WITH {PORTS} SELECT {', '.join(KEYS)}, {_rich('src_port')}, {_rich('dst_port')} FROM ports")
def port_buckets_rich(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["src_port", "dst_port"]
    return ports(spark, sf_dir).select(*KEYS, *[f for n in names for f in scalars.port_flags(F.col(n), n)])


def _simple(port: str) -> str:
    return f"""
  CASE WHEN {port} < 0 OR {port} > 65535 THEN NULL WHEN {port} <= 1023 THEN 0 WHEN {port} <= 49151 THEN 1 ELSE 2 END AS {port}_category,
  ({port} IN (80, 443, 8080))::INTEGER AS {port}_is_web,
  ({port} IN (443, 22, 993, 995))::INTEGER AS {port}_is_secure"""


@query(f"WITH {PORTS} SELECT {', '.join(KEYS)}, {_simple('src_port')}, {_simple('dst_port')} FROM ports")
def port_buckets_simple(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["src_port", "dst_port"]
    return ports(spark, sf_dir).select(*KEYS, *[f for n in names for f in scalars.port_category(F.col(n), n)])


@query(f"WITH {GAPS} SELECT * FROM gaps WHERE quantity IS NOT NULL AND discount IS NOT NULL")
def not_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.require_not_null(gaps(spark, sf_dir), ["quantity", "discount"])


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem WHERE l_linestatus = 'F' AND l_discount > 0.05 AND l_quantity <= 30
UNION ALL
SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem WHERE l_linestatus = 'O'""")
def align_and_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    first = rows.where((F.col("l_linestatus") == "F") & (F.col("l_discount") > 0.05) & (F.col("l_quantity") <= 30))
    second = rows.where(F.col("l_linestatus") == "O").select("l_tax", "l_quantity", "l_linenumber", "l_orderkey", "l_suppkey")
    return columns.union_common([first.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag"), second])
