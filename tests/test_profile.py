import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabscope.functions.scalars import LARGEST_DOUBLE
from tabscope.operators import columns, profile
from tabscope.operators.quantiles import exact_quantiles


def values(spark, numbers, group="g"):
    return spark.createDataFrame([(group, float(x)) for x in numbers], "g string, value double")


@pytest.mark.parametrize("limit", [7])
def test_narrowed_quantiles_equal_numpy(spark, limit):
    rng = np.random.default_rng(1)
    data = {
        "normal": rng.normal(size=400),
        "heavy": np.exp(rng.normal(scale=6, size=300)),
        "ties": np.repeat([1.0, 2.0, 3.0], [200, 5, 95]),
        "one": np.array([4.5]),
        "wide": np.array([-1e300, -1.0, 0.0, 1e-300, 1.0, 1e300]),
    }
    rows = [(g, float(x)) for g, xs in data.items() for x in xs]
    df = spark.createDataFrame(rows, "g string, value double")
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.99, "e": 1.0}
    found = exact_quantiles(df, ["g"], "value", wanted, max_group_rows=limit).collect()
    assert {r["g"] for r in found} == set(data)
    for r in found:
        for name, p in wanted.items():
            assert math.isclose(r[name], np.quantile(data[r["g"]], p), rel_tol=1e-12, abs_tol=1e-300), (r, name)


def test_narrowed_quantiles_with_infinities_and_gaps(spark):
    numbers = [None, float("nan"), float("-inf"), 1.0, 2.0, 3.0, float("inf")]
    df = spark.createDataFrame([("g", x) for x in numbers], "g string, value double")
    row = exact_quantiles(df, ["g"], "value", {"q": 0.5, "lo": 0.0}, max_group_rows=1).first()
    assert row["q"] == 2.0 and row["lo"] == float("-inf")


def test_describe_edge_columns(spark):
    df = spark.createDataFrame(
        [(1.0, None, "b", 7), (None, None, "a", 7)], "`Flow Bytes/s` double, empty double, `Traffic Type` string, konst int"
    )
    rows = {r["feature"]: r for r in profile.describe(df).collect()}
    assert rows["Flow Bytes/s"]["count"] == 1 and rows["Flow Bytes/s"]["null_count"] == 1
    assert rows["Flow Bytes/s"]["std"] is None and rows["Flow Bytes/s"]["p50"] == 1.0
    assert rows["empty"]["count"] == 0 and rows["empty"]["mean"] is None
    assert (rows["Traffic Type"]["min_text"], rows["Traffic Type"]["max_text"]) == ("a", "b")
    table = {r["statistic"]: r for r in profile.describe_table(profile.describe(df)).collect()}
    assert list(table) == ["count", "null_count", "mean", "std", "min", "25%", "50%", "75%", "max"]
    assert table["max"]["Traffic Type"] == "b" and table["50%"]["konst"] == "7.0"


def test_empty_table(spark):
    df = spark.createDataFrame([], "x double, c string")
    assert profile.category_percentages(df, ["c"]).count() == 0
    assert profile.histogram(df, ["x"]).count() == 0
    assert profile.box_statistics(df, ["x"]).count() == 0
    assert profile.describe(df, ["x"]).count() == 0


def test_constant_feature_histogram(spark):
    df = values(spark, [3.0] * 4)
    rows = profile.histogram(df, ["value"]).collect()
    assert len(rows) == 50 and sum(r["count"] for r in rows) == 4
    assert min(r["bin_start"] for r in rows) == 2.5
    assert sum(r["density"] for r in rows) / 50 == pytest.approx(1.0)


def test_box_statistics_whiskers_and_outliers(spark):
    df = values(spark, [1, 2, 3, 4, 5, 100])
    row = profile.box_statistics(df, ["value"]).first()
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 1)
    assert [r["value"] for r in profile.box_outliers(df, ["value"]).collect()] == [100.0]


def test_flags(spark):
    schema = "feature string, mean double, std double, min double, p25 double, p50 double, p75 double, max double"
    rows = [
        # Published describe values of a port column and a protocol column, and a constant.
        ("port", 4050.3, 12685.8323, 0.0, 0.0, 0.0, 0.0, 65535.0),
        ("protocol", 6.43, 2.125669664, 0.0, 6.0, 6.0, 6.0, 17.0),
        ("konst", 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]
    found = {r["feature"]: tuple(r)[1:] for r in profile.distribution_flags(spark.createDataFrame(rows, schema)).collect()}
    assert found["port"] == ("no", "small gap", "yes", "yes", "Right long-tailed")
    assert found["protocol"] == ("no", "small gap", "no", "no", "Both tails")
    assert found["konst"] == ("yes", "small gap", "yes", "no", "Not long-tailed")
    flags = profile.distribution_flags(spark.createDataFrame(rows, schema))
    assert {r[0] for r in profile.problematic_features(flags).collect()} == {"port", "konst"}


def test_remove_zero_variance_keeps_targets(spark):
    df = spark.createDataFrame([(1, 5, 2.0, "x"), (1, 5, 3.0, "x")], "k int, target int, v double, s string")
    assert profile.remove_zero_variance_columns(df, keep=["target"]).columns == ["target", "v", "s"]


def test_clean_and_fill(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (2.0,)], "x double")
    clean = [r[0] for r in columns.clean_numeric(df).collect()]
    assert clean == [0.0, LARGEST_DOUBLE, -LARGEST_DOUBLE, None, 2.0]
    filled = [r[0] for r in columns.fill_numeric(df).collect()]
    assert filled == [0.0, float("inf"), float("-inf"), 0.0, 2.0]


def test_label_domain(spark):
    df = spark.createDataFrame([("Benign",), ("Malicious",)], "label string")
    assert columns.check_label_domain(df, "label", ["Benign", "Malicious"]) is df
    with pytest.raises(ValueError, match="unexpected"):
        columns.check_label_domain(df, "label", ["Benign"])
    with pytest.raises(ValueError, match="not found"):
        columns.check_label_domain(df, "other", ["Benign"])


def test_strict_drop(spark):
    df = spark.range(1).withColumn("a.b", F.lit(1))
    with pytest.raises(ValueError):
        columns.drop_columns(df, ["nope"], strict=True)
    assert columns.drop_columns(df, ["id", "nope"]).columns == ["a.b"]


def test_dictionary_encode_unknown_and_null(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "x string")
    codes = columns.dictionary(df.where("x <> 'c'"), "x")
    found = {r["x"]: r["code"] for r in columns.dictionary_encode(df, "x", codes, unknown=-1).collect()}
    assert found == {"a": 0, "b": 1, "c": -1, None: -1}


def test_safe_names(spark):
    df = spark.range(1).select(*[F.lit(1).alias(c) for c in ("Flow Bytes/s", "a<b>:c", "(x) y ", "plain")])
    assert {r["column"]: r["safe"] for r in columns.safe_names(df).collect()} == {
        "Flow Bytes/s": "Flow_Bytes_s", "a<b>:c": "a_b_c", "(x) y ": "x_y", "plain": "plain",
    }
