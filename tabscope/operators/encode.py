"""Feature encoding: scaling, category codes, one-hot columns, and a fitted column-wise preprocessor."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.scalars import LARGEST_DOUBLE, col, port_category, port_flags
from tabscope.operators.columns import dictionary, dictionary_encode, numeric_columns
from tabscope.operators.profile import to_long
from tabscope.session import checkpoint

# Fixed values.
ONE_HOT_COLUMNS = ("Protocol", "Down/Up Ratio", "RST Flag Count", "FIN Flag Count")
ORDINAL_COLUMNS = ("SYN Flag Count", "CWR Flag Count", "ECE Flag Count")
PORT_COLUMNS = ("Src Port", "Dst Port")

# Categories that become columns of a wide table.
MAX_COLUMNS = 1000


def scaling(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each feature; a constant one gets deviation 1."""
    rows = to_long(df, features).groupBy("feature").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    found = {r["feature"]: (r["m"] or 0.0, r["s"] or 1.0) for r in rows.collect()}
    return {c: found.get(c, (0.0, 1.0)) for c in features}


def scaled(name: str, fitted: dict[str, tuple[float, float]]) -> Column:
    mean, deviation = fitted[name]
    return (col(name).cast("double") - F.lit(mean)) / F.lit(deviation)


def standard_scale(df: DataFrame, features: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Z-score the features with the moments of ``fit_on`` (by default of ``df`` itself)."""
    fitted = scaling(df if fit_on is None else fit_on, features)
    return df.withColumns({c: scaled(c, fitted) for c in features})


def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct values that become the columns of a wide table, so there must be few; codes have no such limit."""
    found = [r[0] for r in df.select(col(column)).distinct().limit(MAX_COLUMNS + 2).collect()]
    found = sorted(v for v in found if v is not None)
    if len(found) > MAX_COLUMNS:
        raise ValueError(f"{column!r} has more than {MAX_COLUMNS} categories; use one_hot_vector()")
    return found


def one_hot(column: str, fitted: Sequence) -> list[Column]:
    """One 0/1 column for each fitted category; an unknown value gives zeros only."""
    return [
        F.coalesce((col(column) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{column}={v}") for v in fitted
    ]


def ordinal_encode(df: DataFrame, column: str, codes: DataFrame, out: str = "code", unknown: int = -1) -> DataFrame:
    """Add the rank of the value in a dictionary (``columns.dictionary``), ``unknown`` for any other value and null."""
    return dictionary_encode(df, column, codes, out, unknown)


def one_hot_vector(df: DataFrame, column: str, codes: DataFrame, out: str) -> DataFrame:
    """Add a sparse vector with a 1 at the code of the value and as many entries as the dictionary; zeros for any other value."""
    size = codes.count()
    coded = dictionary_encode(df, column, codes, "_at", size)
    return _sparse(coded, {"_at": size}, {"_at": out}).drop("_at")


def _sparse(df: DataFrame, sizes: dict[str, int], names: dict[str, str]) -> DataFrame:
    """Sparse vectors of the given sizes from columns of codes; a code equal to the size gives zeros."""
    if not sizes:
        return df
    largest = df.sparkSession.range(1).select(*[F.lit(float(max(n - 1, 0))).alias(c) for c, n in sizes.items()])
    encoder = OneHotEncoder(inputCols=list(sizes), outputCols=[names[c] for c in sizes], handleInvalid="keep", dropLast=True)
    return encoder.fit(largest).transform(df)


def label_index(df: DataFrame, label: str, out: str = "label_index", classes: Sequence | None = None) -> DataFrame:
    """Add the rank of the class among the sorted classes; an unseen class is an error when evaluated.

    Without ``classes`` the ranks come from a dictionary that is joined, whatever the number of classes.
    """
    if classes is None:
        coded = dictionary_encode(df, label, None, "_rank")
    else:
        coded = df.withColumn("_rank", F.array_position(F.array(*[F.lit(v) for v in classes]), col(label)) - 1)
    seen = F.col("_rank").isNotNull() & (F.col("_rank") >= 0)
    checked = F.when(seen, F.col("_rank")).otherwise(
        F.raise_error(F.concat(F.lit("unseen class: "), F.coalesce(col(label).cast("string"), F.lit("null"))))
    )
    return coded.withColumn(out, checked.cast("long")).drop("_rank")


def complete(value: Column) -> Column:
    """Null and NaN become 0, an infinity the largest finite value; the expression is evaluated once."""
    present = F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
    return F.greatest(F.least(present, F.lit(LARGEST_DOUBLE)), F.lit(-LARGEST_DOUBLE))


@dataclass
class Preprocessor:
    """Column-wise encoding, fitted once and applied to any table with the same columns.

    Every numeric column is scaled; ordinal, port and one-hot columns enter again in their encoded form;
    binary columns are scaled with the other numeric ones. NaN and infinities are cleaned at the end. Categories are kept as
    dictionaries (tables), of any size.
    """

    ordinal_columns: Sequence[str] = ORDINAL_COLUMNS
    port_columns: Sequence[str] = PORT_COLUMNS
    one_hot_columns: Sequence[str] = ONE_HOT_COLUMNS
    simple_ports: bool = False
    exclude: Sequence[str] = ()
    _scaling: dict = field(default_factory=dict)
    _codes: dict = field(default_factory=dict)
    _sizes: dict = field(default_factory=dict)
    _ports: list = field(default_factory=list)

    def fit(self, df: DataFrame) -> "Preprocessor":
        present = set(df.columns)
        self._scaling = scaling(df, numeric_columns(df, self.exclude))
        coded = dict.fromkeys(c for c in [*self.ordinal_columns, *self.one_hot_columns] if c in present)
        self._codes = {c: checkpoint(dictionary(df, c)) for c in coded}
        self._sizes = {c: codes.count() for c, codes in self._codes.items()}
        self._ports = [c for c in self.port_columns if c in present]
        return self

    def _named(self) -> dict[str, str]:
        """The column of codes of each coded column, as ``coded`` adds it."""
        return {c: f"_code{i}" for i, c in enumerate(self._codes)}

    def coded(self, df: DataFrame) -> DataFrame:
        """``df`` with a column of codes for each column with a dictionary; the number of categories for unknown values."""
        for c, name in self._named().items():
            df = dictionary_encode(df, c, self._codes[c], name, self._sizes[c])
        return df

    def dense(self) -> list[Column]:
        """The entries that are no one-hot columns, as expressions over ``coded``."""
        # Flags and codes are never null, NaN or infinite; scaled values can be.
        parts = [complete(scaled(c, self._scaling)).alias(f"scaled {c}") for c in self._scaling]
        names = self._named()
        parts += [
            F.when(F.col(names[c]) < self._sizes[c], F.col(names[c])).otherwise(-1).alias(f"ordinal {c}")
            for c in self.ordinal_columns if c in names
        ]
        for c in self._ports:
            parts += port_category(col(c), c) if self.simple_ports else port_flags(col(c), c)
        return parts

    def width(self) -> int:
        """Entries of the vector."""
        return len(self.dense()) + sum(self._sizes[c] for c in self.one_hot_columns if c in self._sizes)

    def columns(self) -> list[Column]:
        """Every entry of the vector as an expression over ``coded``; ``transform`` does without the one-hot ones."""
        names = self._named()
        hot = [(F.col(names[c]) == k).cast("int").alias(f"{c} #{k}") for c in self.one_hot_columns if c in names for k in range(self._sizes[c])]
        return self.dense() + hot

    def transform(self, df: DataFrame, out: str = "features", keep: Sequence[str] = ()) -> DataFrame:
        """(keep..., out): the encoded columns as one vector, sparse where that is shorter.

        Dictionaries are joined, so neither the plan nor the work per row grows with the number of categories.
        """
        kept = [f"_k{i}" for i in range(len(keep))]
        names = self._named()
        hot = {c: f"_h{i}" for i, c in enumerate(c for c in self.one_hot_columns if c in names)}
        dense = array_to_vector(F.array(*[p.cast("double") for p in self.dense()])).alias("_dense")
        codes = [F.col(names[c]).cast("double").alias(f"{h}_at") for c, h in hot.items()]
        rows = self.coded(df).select(*[col(k).alias(n) for k, n in zip(keep, kept, strict=True)], dense, *codes)
        rows = _sparse(rows, {f"{h}_at": self._sizes[c] for c, h in hot.items()}, {f"{h}_at": h for h in hot.values()})
        rows = VectorAssembler(inputCols=["_dense", *hot.values()], outputCol="_out").transform(rows)
        return rows.select(*[F.col(n).alias(k) for k, n in zip(keep, kept, strict=True)], F.col("_out").alias(out))
