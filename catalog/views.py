"""Input tables of the queries: the given tables with a few derived columns, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "disc_price", "charge", "konst"]
BASIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

LI = """li AS (
  SELECT *, l_extendedprice * (1 - l_discount) AS disc_price,
    l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, 0::DOUBLE AS konst,
    CASE WHEN l_returnflag = 'R' THEN 'Malicious' ELSE 'Benign' END AS label
  FROM lineitem)"""

GAPS = """gaps AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag,
    CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS quantity,
    CASE l_linenumber WHEN 1 THEN 'NaN'::DOUBLE WHEN 2 THEN 'Infinity'::DOUBLE
      WHEN 3 THEN '-Infinity'::DOUBLE WHEN 4 THEN NULL ELSE l_discount END AS discount
  FROM lineitem)"""

LAB = """lab AS (
  SELECT d.doc_id, l.quality, l.toxic, d.n_chars, d.lang, d.source,
    concat(l.quality, '_', l.toxic) AS cls
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

# The service ports that some rows are given, in the order of their supplier number.
SERVICE_PORTS = [80, 443, 8080, 8443, 25, 465, 587, 110, 143, 993, 995, 20, 21, 22, 69, 53]

PORTS = f"""ports AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
    CASE WHEN l_linenumber <= 4 THEN (l_orderkey * 37) % 65536
      ELSE ({SERVICE_PORTS})[(l_suppkey % 16 + 1)::INTEGER] END::BIGINT AS src_port,
    (l_partkey * 101) % 65536 AS dst_port
  FROM lineitem)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def li(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf_dir, "lineitem").drop("l_shipdate").select(
        "*", price.alias("disc_price"), (price * (1 + F.col("l_tax"))).alias("charge"),
        F.lit(0.0).alias("konst"),
        F.when(F.col("l_returnflag") == "R", "Malicious").otherwise("Benign").alias("label"),
    )


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, "l_returnflag",
        F.when(n == 1, None).otherwise(F.col("l_quantity")).alias("quantity"),
        F.when(n == 1, float("nan")).when(n == 2, float("inf")).when(n == 3, float("-inf"))
        .when(n == 4, None).otherwise(F.col("l_discount")).alias("discount"),
    )


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang", "source")
    return table(spark, sf_dir, "labels").join(documents, "doc_id").select(
        "doc_id", "quality", "toxic", "n_chars", "lang", "source",
        F.concat(F.col("quality"), F.lit("_"), F.col("toxic")).alias("cls"),
    )


def ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    service = F.array(*[F.lit(p) for p in SERVICE_PORTS])
    given = F.element_at(service, (F.col("l_suppkey") % 16 + 1).cast("int"))
    return table(spark, sf_dir, "lineitem").select(
        *KEYS, "l_quantity",
        F.when(F.col("l_linenumber") <= 4, F.col("l_orderkey") * 37 % 65536).otherwise(given).cast("long").alias("src_port"),
        (F.col("l_partkey") * 101 % 65536).alias("dst_port"),
    )


def emb(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The embeddings with one double column per dimension; the width is read from the data."""
    vectors = table(spark, sf_dir, "embeddings")
    width = len(vectors.select("embedding").first()[0])
    names = [f"e{i}" for i in range(width)]
    wide = vectors.select(
        "vec_id", "label", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(names)]
    )
    return wide, names


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    """Round the named columns and turn -0.0 into 0.0."""
    return df.withColumns({n: F.round(F.col(n), places) + F.lit(0.0) for n in names})


def long_sql(source: str, features: Sequence[str], by: Sequence[str] = ()) -> str:
    """UNION ALL of (by..., feature, value)."""
    keys = "".join(f"{b}, " for b in by)
    return " UNION ALL ".join(
        f"SELECT {keys}'{f}' AS feature, {f}::DOUBLE AS value FROM {source}" for f in features
    )


def digest_sql(seed: int, keys: Sequence[str]) -> str:
    return f"md5(concat_ws('_', '{seed}', {', '.join(keys)}))"


def registrar(registry: dict) -> Callable:
    """Decorator that registers a query under its function name with its SQL text."""

    def query(sql: str | None = None) -> Callable:
        def add(fn: Callable) -> Callable:
            registry[fn.__name__] = (fn, sql)
            return fn

        return add

    return query


