"""Column-level operators: listing, dropping, encoding and checking columns of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabscope.functions.aggregates import join_on, small
from tabscope.functions.scalars import col, fill_zero, finite, sanitize_name
from tabscope.session import checkpoint


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the columns of any numeric type, in table order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def column_listing(df: DataFrame) -> DataFrame:
    """(position, column, dtype, is_numeric) of every column."""
    numeric = set(numeric_columns(df))
    rows = [(i, name, dtype, name in numeric) for i, (name, dtype) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string, is_numeric boolean")


def present_counts(df: DataFrame) -> DataFrame:
    """``column_listing`` with ``present``, the number of rows with a value: one aggregate over all columns."""
    counts = df.agg(*[F.count(col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_{i}").alias("present")) for i, c in enumerate(df.columns)])
    return column_listing(df).join(counts.select(F.inline(pairs)), "column")


def safe_names(df: DataFrame) -> DataFrame:
    """(column, safe): every column name with its form for files and identifiers."""
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column string")
    return names.withColumn("safe", sanitize_name(F.col("column")))


def drop_columns(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Drop columns; ``strict`` raises if one is absent, otherwise absent names are ignored."""
    absent = [n for n in names if n not in df.columns]
    if strict and absent:
        raise ValueError(f"columns not found: {absent}")
    return df.select(*[col(c) for c in df.columns if c not in set(names)])


def require_not_null(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows in which every named column is present."""
    for n in names:
        df = df.where(col(n).isNotNull())
    return df


def fill_numeric(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Null and NaN become 0 in the numeric columns."""
    chosen = numeric_columns(df) if names is None else list(names)
    return df.withColumns({c: fill_zero(col(c)) for c in chosen})


def clean_numeric(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes 0, an infinity the largest finite value; nulls stay."""
    chosen = numeric_columns(df) if names is None else list(names)
    return df.withColumns({c: finite(col(c).cast("double")) for c in chosen})


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """(column, code): sorted distinct values with their 0-based rank.

    The ranks follow from a distributed sort and the row counts of its partitions, so a column with very
    many categories never meets in one task.
    """
    categories = df.where(col(column).isNotNull()).select(col(column).alias("_v")).distinct()
    ranged = checkpoint(categories.repartitionByRange("_v").withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition.
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_v")) - 1
    ranked = ranged.withColumn("_place", place).join(F.broadcast(sizes), "_part")
    return ranked.select(F.col("_v").alias(column), (F.col("_before") + F.col("_place")).cast("long").alias("code"))


def dictionary_encode(
    df: DataFrame, column: str, codes: DataFrame | None = None, out: str = "code", unknown: int | None = None
) -> DataFrame:
    """Add the rank of ``column`` in a dictionary; values outside it get ``unknown``."""
    codes = checkpoint(dictionary(df, column) if codes is None else codes)
    coded = join_on(df, small(codes.withColumnRenamed("code", "_code")), [column], "left")
    value = F.col("_code") if unknown is None else F.coalesce(F.col("_code"), F.lit(unknown))
    return coded.withColumn(out, value).drop("_code")


def unexpected_labels(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct labels outside the allowed domain, a missing label included."""
    distinct = df.select(col(column)).distinct()
    return distinct.where(~F.coalesce(col(column).isin(*allowed), F.lit(False)))


def check_label_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error when the column is absent or holds an unexpected label."""
    if column not in df.columns:
        raise ValueError(f"label column {column!r} not found")
    found = [r[0] for r in unexpected_labels(df, column, allowed).limit(10).collect()]
    if found:
        raise ValueError(f"unexpected labels: {found}")
    return df


def castable_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, castable): can every present value be read as a number? One aggregate for all columns."""
    bad = [
        F.count_if(col(c).isNotNull() & col(c).cast("string").try_cast("double").isNull()).alias(f"_{i}")
        for i, c in enumerate(names)
    ]
    pairs = [F.struct(F.lit(c).alias("column"), (F.col(f"_{i}") == 0).alias("castable")) for i, c in enumerate(names)]
    return df.agg(*bad).select(F.explode(F.array(*pairs)).alias("p")).select("p.column", "p.castable")


def union_common(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL over the columns that all frames share, in the order of the first frame."""
    common = set(frames[0].columns).intersection(*[f.columns for f in frames[1:]])
    ordered = [c for c in frames[0].columns if c in common]
    result = frames[0].select(*[col(c) for c in ordered])
    for frame in frames[1:]:
        result = result.unionByName(frame.select(*[col(c) for c in ordered]))
    return result
