"""k-means and density samples for all strata at once, and the exact neighbour index under them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabscope.operators import cluster_sampling as cs
from tabscope.operators import neighbours


def points(spark, rows, width):
    schema = "id long, s string, " + ", ".join(f"x{i} double" for i in range(width))
    return spark.createDataFrame([(i, s, *map(float, x)) for i, (s, x) in enumerate(rows)], schema)


@pytest.fixture(scope="module")
def fifth(spark):
    """Six features. In stratum p two groups differ in the fifth only; in q nothing differs; r is constant."""
    side = F.when(F.col("id") % 4 == 0, -5.0).otherwise(5.0)
    p = spark.range(80000).where("id % 2 = 0").select(
        "id", F.lit("p").alias("s"), *[(F.rand(i) if i != 4 else side + F.rand(i) / 3).alias(f"x{i}") for i in range(6)]
    )
    q = spark.range(80000).where("id % 2 = 1").select("id", F.lit("q").alias("s"), *[F.rand(10 + i).alias(f"x{i}") for i in range(6)])
    r = spark.range(80000, 80030).select("id", F.lit("r").alias("s"), *[F.lit(1.0).alias(f"x{i}") for i in range(6)])
    return p.unionAll(q).unionAll(r).cache(), [f"x{i}" for i in range(6)]


def test_clusters_that_differ_in_the_fifth_direction_of_one_stratum(fifth):
    df, features = fifth
    scored = cs.scaled_in_stratum(df, ["s"], features)
    for turned in (True, False):
        found = cs.density_clusters(scored, ["s"], ["id"], turned=turned).join(df.select("id", "x4"), "id")
        rows = found.groupBy("s", (F.col("x4") < 0).alias("low"), "cluster").count().collect()
        assert sum(r["count"] for r in rows) == 80030
        low = {r["cluster"] for r in rows if r["s"] == "p" and r["low"]} - {None}
        high = {r["cluster"] for r in rows if r["s"] == "p" and not r["low"]} - {None}
        assert len(low) == len(high) == 1 and low != high
        assert len({r["cluster"] for r in rows if r["s"] == "q"} - {None}) == 1
        assert len({r["cluster"] for r in rows if r["s"] == "r"}) == 1


def test_axes_are_uncorrelated_in_every_stratum(fifth):
    df, features = fifth
    mixed = df.withColumns({"x1": F.col("x0") * 3 + F.col("x1"), "x5": F.col("x2") - F.col("x3")})
    scored = cs.scaled_in_stratum(mixed, ["s"], features)
    axes = {r["part"]: r for r in cs.stratum_axes(scored, ["s"]).collect()}
    for s in ("p", "q"):
        x = np.array(scored.where(F.col("s") == s).select("_x").toPandas()["_x"].tolist())
        got = axes[f'["{s}"]']
        assert got["rows"] == 40000 and len(got["axes"]) == 5
        along = x @ np.array([a["direction"] for a in got["axes"]]).T
        covariance = along.T @ along / len(x)
        assert np.abs(covariance - np.diag(np.diag(covariance))).max() < 0.03
        assert [a["width"] * 40000 ** (1 / 7) / 3.49 for a in got["axes"]] == pytest.approx(np.sqrt(np.diag(covariance)))
        # They span the features: nothing of them is left over.
        assert np.abs(x - along @ np.linalg.lstsq(along, x, rcond=None)[0]).max() < 1e-6
    assert axes['["r"]']["axes"] == []


def test_many_strata_and_null_strata_need_no_limit(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 1500 > 0, (F.col("id") % 1500).cast("string")).alias("s"), (F.col("id") / 7).alias("x"))
    sample = cs.kmeans_sample(df, ["s"], ["x"], ["id"], 1500, inits=2)
    assert sample.groupBy("s").count().where("count = 1").count() == 1500
    assert cs.density_sample(df, ["s"], ["x"], ["id"], 1500).groupBy("s").count().where("count = 1").count() == 1500


def test_kmeans_cost_is_as_low_as_planted(spark):
    rng = np.random.default_rng(3)
    centres = rng.uniform(-50, 50, (12, 4))
    rows = [(s, centres[k % 12] + rng.normal(0, 0.1, 4)) for s in "ab" for k in range(240)]
    df = points(spark, rows, 4)
    sample = cs.kmeans_sample(df, ["s"], ["x0", "x1", "x2", "x3"], ["id"], 24, inits=10)
    found = sorted((r["s"], r["id"] % 240 % 12) for r in sample.collect())
    assert found == [(s, k) for s in "ab" for k in range(12)]


def test_step_matches_numpy(spark):
    rng = np.random.default_rng(5)
    x, centres = rng.normal(size=(200, 3)), rng.normal(size=(2, 4, 3))
    df = spark.createDataFrame([("a" if i % 2 else "b", [float(v) for v in p]) for i, p in enumerate(x)], "part string, x array<double>")
    rows = {(r["part"], r["seed"], r["cluster"]): r for r in cs.lloyd_step(df, {"a": centres, "b": centres + 1}).collect()}
    for part, own, c in (("a", x[1::2], centres), ("b", x[::2], centres + 1)):
        for s in range(2):
            d = ((own[:, None] - c[s]) ** 2).sum(2)
            for k in range(4):
                mine = own[d.argmin(1) == k]
                assert ((part, s, k) in rows) == (len(mine) > 0)
                if len(mine):
                    r = rows[part, s, k]
                    assert r["rows"] == len(mine) and r["centre"] == pytest.approx(mine.mean(0))
                    assert r["cost"] == pytest.approx(d.min(1)[d.argmin(1) == k].sum())


def test_fewer_different_rows_than_clusters(spark):
    df = spark.range(60).select("id", F.lit("s").alias("s"), (F.col("id") % 2).cast("double").alias("x"))
    sample = cs.kmeans_sample(df, ["s"], ["x"], ["id"], 10, inits=2)
    assert sorted(r["x"] for r in sample.collect()) == [0.0, 1.0]


@pytest.fixture(scope="module")
def cloud(spark):
    x = np.random.default_rng(0).normal(size=(600, 3))
    df = spark.createDataFrame([(str(i % 2), str(i), [float(v) for v in p]) for i, p in enumerate(x)], "part string, key string, vector array<double>")
    return x, df.cache()


@pytest.mark.parametrize("rows", [20_000, 7])
def test_index_finds_the_nearest_point(monkeypatch, cloud, rows):
    monkeypatch.setattr(neighbours, "BALL_ROWS", rows)
    x, df = cloud
    index = neighbours.BallIndex(df.where("key % 3 = 0"))
    got = {int(r["key"]): r["nearest"] for r in index.nearest(df).collect()}
    for i in range(600):
        others = [j for j in range(0, 600, 3) if j % 2 == i % 2 and j != i]
        assert got[i] == pytest.approx(np.sqrt(((x[others] - x[i]) ** 2).sum(1)).min(), abs=1e-12)


@pytest.mark.parametrize("rows", [20_000, 7])
def test_index_connects_what_touches(monkeypatch, cloud, rows):
    monkeypatch.setattr(neighbours, "BALL_ROWS", rows)
    x, df = cloud

    def components(edges):
        root = list(range(600))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in edges:
            low, high = sorted((find(a), find(b)))
            root[high] = low
        return [find(i) for i in range(600)]

    edges = [(int(r["a"]), int(r["b"])) for r in neighbours.BallIndex(df, "chebyshev").touching(0.5).collect()]
    close = np.abs(x[:, None] - x[None]).max(2) <= 0.5
    want = [(i, j) for i in range(600) for j in range(i) if i % 2 == j % 2 and close[i, j]]
    assert components(edges) == components(want)


def test_points_without_neighbours(spark):
    one = spark.createDataFrame([("", "a", [1.0]), ("x", "b", [2.0])], "part string, key string, vector array<double>")
    index = neighbours.BallIndex(one)
    assert {(r["key"], r["nearest"]) for r in index.nearest(one).collect()} == {("a", None), ("b", None)}
    assert index.touching(5.0).count() == 0


@pytest.mark.parametrize("metric", ["euclidean", "chebyshev"])
def test_close_pairs_are_those_of_all_distances(metric):
    rng = np.random.default_rng(3)
    for size, scale, shift in ((40, 1.0, 0.0), (2, 1e-3, 1e3), (3, 1e180, 0.0)):
        x = rng.normal(size=(90, size)) * scale + shift
        y = np.concatenate([x[:30], rng.normal(size=(60, size)) * scale + shift, x[:20] * (1 + 1e-15)])
        y[-1, 0] = np.nan
        d = neighbours.distances(x, y, metric)
        best = np.full(len(x), np.inf)
        q, _, found = neighbours.close_pairs(x, y, metric)
        np.minimum.at(best, q, np.where(found > 0, found, np.inf))
        assert (best == np.where(d > 0, d, np.inf).min(1)).all()
        for cut in (0.0, np.median(d[:, :-1])):
            q, p, _ = neighbours.close_pairs(x, y[:-1], metric, np.full(len(x), cut))
            assert (np.argwhere(d[:, :-1] <= cut) == np.stack([q, p], 1)).all()


def test_a_query_travels_once_for_a_group_of_balls(monkeypatch, spark):
    x = np.random.default_rng(8).normal(size=(400, 40))
    df = spark.createDataFrame([("", str(i), [float(v) for v in r]) for i, r in enumerate(x)], "part string, key string, vector array<double>")
    index, sent, union = neighbours.BallIndex(df), [], type(df).unionByName
    monkeypatch.setattr(type(df), "unionByName", lambda self, other, *a: sent.append(other.count()) or union(self, other, *a))
    got = {int(r["key"]): r["nearest"] for r in index.nearest(df).collect()}
    assert len(index.pivots) > 10 and len(sent) == 2 and max(sent) <= 400
    d = neighbours.distances(x, x, "euclidean")
    np.fill_diagonal(d, np.inf)
    assert [got[i] for i in range(400)] == d.min(1).tolist()
