"""Reading tables: Parquet with a CSV fallback, pruned scans, CSV results and the column-group file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.scalars import col


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def load_table(spark: SparkSession, base: str, schema: T.StructType | str | None = None) -> DataFrame:
    """``base.parquet``, or ``base.csv`` converted to it on first use.

    Without ``schema`` the CSV types are inferred, which costs an extra pass over the file. Raises if
    neither file exists.
    """
    try:
        return spark.read.parquet(f"{base}.parquet")
    except AnalysisException as error:
        if not _missing(error):
            raise
    read_csv(spark, f"{base}.csv", schema).write.parquet(f"{base}.parquet")
    return spark.read.parquet(f"{base}.parquet")


def read_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet scan that reads the named columns only."""
    return spark.read.parquet(path).select(*[col(c) for c in columns])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """Delimited file with a header line."""
    reader = spark.read.option("header", True).option("sep", sep)
    return (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)


def read_column_groups(spark: SparkSession, path: str) -> DataFrame:
    """(group, feature) from a JSON object of group names and lists of column names."""
    text = spark.read.text(path, wholetext=True)
    groups = text.select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("group", "features"))
    return groups.select("group", F.explode("features").alias("feature"))


def column_groups(spark: SparkSession, groups: dict[str, Sequence[str]]) -> DataFrame:
    """The same table from a dictionary."""
    rows = [(g, f) for g, features in groups.items() for f in features]
    return spark.createDataFrame(rows, "`group` string, feature string")
