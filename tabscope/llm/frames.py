"""What the operators share on the Spark side: reading, intermediate tables and batch sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.session import scratch_path, ship

BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def batched(df: DataFrame) -> DataFrame:
    """``df``, with Arrow batches bounded in bytes, so that long texts do not add up in a Python worker."""
    ship(df.sparkSession)
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    conf.set("spark.sql.execution.arrow.useLargeVarTypes", "true")
    return df


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_part(doc_id: Column, parts: int = 3) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def with_names(schema, extra: str):
    """The struct type of ``schema`` with the columns of the DDL string ``extra``, which replace equal names."""
    from pyspark.sql.types import StructType, _parse_datatype_string

    added = _parse_datatype_string(extra)
    names = {f.name for f in added}
    return StructType([f for f in schema if f.name not in names] + list(added))
