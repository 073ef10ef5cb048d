import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabscope.functions.tdist import two_sided_p
from tabscope.operators import association, correlate, profile, reduce, select
from tabscope.operators.components import connected_components


def test_components_against_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(f"n{a:03d}", f"n{b:03d}") for a, b in rng.integers(0, 300, size=(180, 2))]
    edges += [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]  # a long chain
    edges += [("hub", f"leaf{i:03d}") for i in range(100)]  # a hot node
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    found = connected_components(spark.createDataFrame(edges, "a string, b string"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in found} == {x: root(x) for x in parent}


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def pairs_of(spark, rows):
    return spark.createDataFrame(rows, "feature1 string, feature2 string, correlation double")


def test_signed_groups_leave_negative_pairs_alone(spark):
    pairs = pairs_of(spark, [("a", "b", 0.9), ("b", "c", 0.7), ("x", "y", -0.95)])
    groups = {r["feature"]: r["group"] for r in select.correlation_groups(pairs).collect()}
    assert groups == {"a": "a", "b": "a", "c": "a"}
    unsigned = {r["feature"] for r in select.correlation_groups(pairs, signed=False).collect()}
    assert unsigned == {"a", "b", "c", "x", "y"}


def test_representative_without_scores_is_first_by_name(spark):
    groups = spark.createDataFrame([("b", "g"), ("a", "g"), ("Label", "g")], "feature string, `group` string")
    assert select.group_representatives(groups, None, ["Label"]).first()["kept_feature"] == "a"


def test_feature_selection_with_target_in_a_group(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0, "x", "y")], "a double, b double, c double, k double, Label string, cls string")
    pairs = pairs_of(spark, [("a", "b", 0.8), ("b", "cls", 0.75)])
    scores = spark.createDataFrame([("a", 0.2), ("b", 0.5), ("c", 0.1)], "feature string, score double")
    found = select.feature_selection(df, pairs, scores, ["Label", "cls"], drop=["k"])
    assert {r["feature"]: (r["status"], r["kept_feature"]) for r in found.collect()} == {
        "a": ("dropped", "b"), "b": ("selected", "b"), "c": ("selected", "c"),
        "Label": ("selected", "Label"), "cls": ("selected", "cls"),
    }
    assert select.selected_columns(df, found) == ["b", "c", "Label", "cls"]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    x[:, 2] = -x[:, 0] + 0.2 * x[:, 2]
    rows = [(*map(float, r), 1.0, "Malicious" if r[0] + r[3] > 0.5 else "Benign") for r in x]
    return spark.createDataFrame(rows, "`a/b` double, b double, c double, d double, k double, Label string"), x


def test_matrix_equals_numpy(numbers):
    df, x = numbers
    long = correlate.numeric_correlations(df)
    names = ["a/b", "b", "c", "d"]
    expected = np.corrcoef(x.T)
    for r in long.collect():
        assert r["r"] == pytest.approx(expected[names.index(r["feature1"]), names.index(r["feature2"])], abs=1e-12)
    assert long.count() == 16
    square = correlate.correlation_matrix(long).collect()
    assert [r["feature"] for r in square] == names


def test_top_pairs_by_sign(numbers):
    long = correlate.numeric_correlations(numbers[0])
    assert [(r[0], r[1]) for r in correlate.top_pairs(long, 1).collect()] == [("a/b", "b")]
    assert {(r[0], r[1]) for r in correlate.top_pairs(long, -1).collect()} == {("a/b", "c"), ("b", "c")}


def test_missing_values_in_matrix(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 100.0), (3.0, 6.0)], "a double, b double")
    skip = correlate.correlation_long(df, ["a", "b"]).where("position1 < position2").first()["r"]
    zero = correlate.correlation_long(df, ["a", "b"], missing="zero").where("position1 < position2").first()["r"]
    assert skip == pytest.approx(1.0) and zero == pytest.approx(np.corrcoef([1, 2, 0, 3], [2, 4, 100, 6])[0, 1])


def test_t_distribution():
    # Exact forms for 1 and 2 degrees of freedom, and the normal limit.
    for t in (0.0, 0.3, 1.0, 2.5, 40.0):
        assert two_sided_p(t, 1) == pytest.approx(1 - 2 * math.atan(t) / math.pi, abs=1e-12)
        assert two_sided_p(t, 2) == pytest.approx(1 - t / math.sqrt(2 + t * t), abs=1e-12)
        assert two_sided_p(t, 1e9) == pytest.approx(math.erfc(t / math.sqrt(2)), abs=1e-9)
    assert two_sided_p(2.0, 1e7 - 1) == pytest.approx(two_sided_p(2.0, 1e7 + 1), abs=1e-7)
    assert math.isnan(two_sided_p(float("nan"), 3)) and two_sided_p(float("inf"), 3) == 0.0


def test_association_against_numpy(numbers):
    df, x = numbers
    y = (x[:, 0] + x[:, 3] > 0.5).astype(float)
    row = association.feature_label_association(df, ["a/b", "d", "k"], "Label").collect()
    by = {r["feature"]: r for r in row}
    a0, a1 = x[y == 0, 0], x[y == 1, 0]
    assert by["a/b"]["point_biserial_corr"] == round(np.corrcoef(x[:, 0], y)[0, 1], 4)
    pooled = math.sqrt(((len(a0) - 1) * a0.var() + (len(a1) - 1) * a1.var()) / (len(x) - 2))
    assert by["a/b"]["cohens_d"] == round(abs(a0.mean() - a1.mean()) / pooled, 4)
    assert (by["a/b"]["benign_count"], by["a/b"]["malicious_count"]) == (len(a0), len(a1))
    assert by["a/b"]["corr_p_value"] == 0.0
    assert by["k"]["point_biserial_corr"] is None and by["k"]["cohens_d"] == 0.0
    summary = association.association_summary(association.feature_label_association(df, ["a/b", "d", "k"], "Label")).first()
    assert summary["analyzed"] == 3 and summary["strong"] == 2 and summary["significant"] == 2


def test_association_skips_one_sided_and_small(spark):
    df = spark.createDataFrame([("Benign", 1.0)] * 20, "Label string, x double")
    assert association.feature_label_association(df, ["x"], "Label").count() == 0
    few = spark.createDataFrame([("Benign", 1.0), ("Malicious", 2.0)] * 4, "Label string, x double")
    assert association.feature_label_association(few, ["x"], "Label").count() == 0


def test_stars(spark):
    df = spark.createDataFrame([(0.0001,), (0.005,), (0.03,), (0.5,)], "p double")
    assert [r[0] for r in df.select(association.significance_stars(F.col("p"))).collect()] == ["***", "**", "*", ""]


def test_pca_equals_eigenvalues(numbers):
    df, x = numbers
    found = reduce.pca_variance(df, ["a/b", "b", "c", "d"], ["a/b", "d"]).collect()
    eigen = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1] / 4
    original = [r["explained"] for r in found if r["dataset"] == "original"]
    assert original == pytest.approx(list(eigen), abs=1e-9)
    summary = reduce.pca_summary(reduce.pca_variance(df, ["a/b", "b", "c", "d"], ["a/b", "d"]), 4, 2).first()
    assert summary["feature_reduction_pct"] == 50.0 and summary["orig_components_for_80pct"] == 2
    assert summary["variance_at_reduced_count"] == round(float(eigen[:2].sum()) * 100, 2)


def test_greedy_clusters_may_overlap(spark):
    rows = []
    names = ["a", "b", "c", "d"]
    strong = {(0, 1), (1, 2), (2, 3)}
    for i, a in enumerate(names):
        for j, b in enumerate(names):
            r = 1.0 if i == j else 0.95 if (min(i, j), max(i, j)) in strong else 0.0
            rows.append((i, j, a, b, r))
    long = spark.createDataFrame(rows, correlate.LONG_SCHEMA)
    found = correlate.greedy_clusters(long).orderBy("cluster", "position").collect()
    assert [(r["cluster"], r["feature"]) for r in found] == [(0, "a"), (0, "b"), (1, "c"), (1, "b"), (1, "d")]


def test_statistic_correlation_of_described_rows(spark):
    df = spark.createDataFrame([(1.0, 10.0, 5.0), (2.0, 30.0, 5.5), (4.0, 20.0, 9.0)], "a double, b double, c double")
    described = profile.describe(df)
    found = {(r["statistic1"], r["statistic2"]): r["r"] for r in correlate.statistic_correlation(described).collect()}
    columns = [[np.mean(v), np.std(v, ddof=1)] for v in ([1, 2, 4], [10, 30, 20], [5, 5.5, 9])]
    assert found["mean", "std"] == pytest.approx(np.corrcoef(np.array(columns).T)[0, 1])
    assert len(found) == 49


@pytest.mark.parametrize("tile", [256, 2])
def test_group_correlation_by_tiles(spark, monkeypatch, tile):
    monkeypatch.setattr(correlate, "TILE", tile)
    monkeypatch.setattr(correlate, "PRODUCTS_HELD", 5)
    rng = np.random.default_rng(2)
    x = rng.normal(1e4, 1, (80, 5))
    x[:, 3] = 2 * x[:, 0] - 7
    rows = [[None if (k == 4 and i % 3 == 0) else float(v) for k, v in enumerate(r)] for i, r in enumerate(x)]
    df = spark.createDataFrame([(*r, 5.0) for r in rows], "a double, b double, `c.c` double, d double, e double, konst double")
    asked = [("one", "a"), ("one", "b"), ("one", "d"), ("one", "konst"), ("two", "c.c"), ("two", "e"), ("two", "a"), ("none", "zz")]
    groups = spark.createDataFrame(asked, "group string, feature string")
    found = {(r["group"], r["feature1"], r["feature2"]): r["r"] for r in correlate.group_correlation(df, groups).collect()}
    want = {}
    for group, names, seen in (("one", "abd", slice(None)), ("two", "ace", np.arange(80) % 3 > 0)):
        columns = [{"c": "c.c"}.get(n, n) for n in names]
        r = np.corrcoef(x[seen][:, ["abcde".index(n) for n in names]].T)
        want |= {(group, p, q): r[i, j] for i, p in enumerate(columns) for j, q in enumerate(columns)}
    assert found.keys() == want.keys()
    assert all(found[k] == pytest.approx(want[k], abs=1e-9) for k in want)
