"""Representative samples by clustering inside each stratum."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabscope.functions.aggregates import join_on, small
from tabscope.functions.scalars import col, fill_zero
from tabscope.operators.components import connected_components
from tabscope.operators.neighbours import BallIndex, matrix
from tabscope.operators.profile import category_counts
from tabscope.operators.ranking import pick
from tabscope.operators.sampling import top_up_rare_classes
from tabscope.session import MAX_GROUP_ROWS, checkpoint, ship, written

# Fixed values.
CLUSTER_SAMPLE_SIZE = 10_000
MIN_CLUSTER_ROWS = 5
MAX_MIN_CLUSTER_ROWS = 50

# Distances that a task computes together; entries of matrices it adds up before it passes them on; entries of axes that are
# sent to all tasks; variance (of z-scored features) up to which a direction counts as constant.
DISTANCES_AT_ONCE = 1 << 22
MOMENTS_HELD = 1 << 23
AXES_SENT = 1 << 20
LEAST_VARIANCE = 1e-6


def cluster_targets(df: DataFrame, strata: Sequence[str], sample_size: int) -> DataFrame:
    """(strata..., target): proportional share of the sample, at least 1 and at most all rows."""
    counts = category_counts(df, strata)
    total = counts.select(F.sum("count")).scalar()
    share = F.greatest(F.round(F.col("count") / total * sample_size), F.lit(1)).cast("long")
    return counts.select(*[col(s) for s in strata], F.least(share, F.col("count")).alias("target"))


def scaled_in_stratum(df: DataFrame, strata: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Add ``_x``: the features, gaps as 0, z-scored inside each stratum (population deviation)."""
    values = {f"_f{i}": fill_zero(col(c)) for i, c in enumerate(features)}
    filled = df.withColumns(values)
    moments = filled.groupBy(*[col(s) for s in strata]).agg(
        *[F.avg(n).alias(f"_m{n}") for n in values], *[F.stddev_pop(n).alias(f"_s{n}") for n in values]
    )
    scores = F.array(
        *[F.coalesce(F.try_divide(F.col(n) - F.col(f"_m{n}"), F.col(f"_s{n}")), F.lit(0.0)) for n in values]
    )
    joined = join_on(filled, small(checkpoint(moments)), strata)
    return joined.withColumn("_x", scores).select(*[col(c) for c in df.columns], "_x")


def nearest_to_centre(
    df: DataFrame, groups: Sequence[str], features: Sequence[str], keys: Sequence[str]
) -> DataFrame:
    """(groups..., keys...) of the row nearest to the mean of every group; ties go to the smallest keys.

    Gaps count as 0. The means are one row per group, combined before they are moved, and so are the nearest rows.
    """
    values = {f"_f{i}": fill_zero(col(c)) for i, c in enumerate(features)}
    filled = df.withColumns(values)
    centres = filled.groupBy(*[col(g) for g in groups]).agg(*[F.avg(n).alias(f"_m{n}") for n in values])
    squares = [(F.col(n) - F.col(f"_m{n}")) * (F.col(n) - F.col(f"_m{n}")) for n in values]
    distance = squares[0]
    for square in squares[1:]:
        distance = distance + square
    # Rounded, so that the order of additions does not decide between equal distances.
    measured = join_on(filled, small(checkpoint(centres)), groups).withColumn("_d", F.round(distance, 9))
    first = F.min(F.struct("_d", *[col(k) for k in keys])).alias("_first")
    found = measured.groupBy(*[col(g) for g in groups]).agg(first)
    return found.select(*[col(g) for g in groups], *[F.col(f"_first.{k}").alias(k) for k in keys])


def _grouped(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray]]:
    """The parts of a batch with their row numbers."""
    parts = batch.column("part").dictionary_encode()
    codes = parts.indices.to_numpy(zero_copy_only=False)
    for code, name in enumerate(parts.dictionary.to_pylist()):
        yield name, np.flatnonzero(codes == code)


def _nearest_centres(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of, and squared distance to, the nearest of (seed, cluster, entry) centres, for every row and seed."""
    seeds, clusters, width = centres.shape
    flat = centres.reshape(-1, width)
    squares = (flat * flat).sum(1)
    chosen = np.empty((len(x), seeds), np.int64)
    step = max(1, DISTANCES_AT_ONCE // len(flat))
    for at in range(0, len(x), step):
        part = x[at : at + step]
        chosen[at : at + step] = (squares - 2 * part @ flat.T).reshape(len(part), seeds, clusters).argmin(2)
    off = [x - centres[s, chosen[:, s]] for s in range(seeds)]
    return chosen, np.stack([(o * o).sum(1) for o in off], 1)


def lloyd_step(rows: DataFrame, centres: dict[str, np.ndarray]) -> DataFrame:
    """(part, seed, cluster, rows, cost, centre): one step of k-means for all strata and seeds together.

    ``rows``: part, x. ``centres`` holds for each part an array (seed, cluster, entry) and goes to every task; callers
    bound it, as ``kmeans_centres`` does. Tasks add up the rows of each cluster, and only these sums are shuffled.
    Clusters without rows are not returned.
    """
    ship(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(centres)
    width = next(iter(centres.values())).shape[2] if centres else 0
    names = [f"s{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            x = matrix(batch.column("x"))
            for name, mine in _grouped(batch):
                if name not in shared.value:
                    continue
                part = x[mine]
                chosen, cost = _nearest_centres(part, shared.value[name])
                seeds, clusters, _ = shared.value[name].shape
                if name not in sums:
                    sums[name] = np.zeros((seeds, clusters, width + 2))
                for s in range(seeds):
                    np.add.at(sums[name][s], chosen[:, s], np.column_stack([part, np.ones(len(part)), cost[:, s]]))
        for name, total in sums.items():
            seed, cluster = np.nonzero(total[:, :, width])
            values = total[seed, cluster]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seed), pa.string()), pa.array(seed.astype(np.int32)), pa.array(cluster.astype(np.int32)),
                 pa.array(values[:, width].astype(np.int64)), pa.array(values[:, width + 1]), *[pa.array(values[:, i]) for i in range(width)]],
                ["part", "seed", "cluster", "rows", "cost", *names],
            )

    schema = "part string, seed int, cluster int, rows long, cost double" + "".join(f", {n} double" for n in names)
    sums = rows.select("part", "x").mapInArrow(run, schema).groupBy("part", "seed", "cluster")
    total = sums.agg(F.sum("rows").alias("rows"), F.sum("cost").alias("cost"), *[F.sum(n).alias(n) for n in names])
    centre = F.array(*[F.col(n) / F.col("rows") for n in names]).cast("array<double>")
    return total.select("part", "seed", "cluster", "rows", "cost", centre.alias("centre"))


def _first_centres(rows: DataFrame, targets: DataFrame, seed: int, inits: int) -> dict[str, np.ndarray]:
    """k-means++ centres for every part and seed, each drawn from about 5 k + 20 rows picked by a hash of seed and key."""
    share = F.least(F.lit(1.0), (5 * F.col("k") + 20) / F.col("size"))
    known = rows.join(small(targets), "part").select("part", "x", "key", "k", share.alias("share"))
    drawn = known.select("*", F.explode(F.sequence(F.lit(0), F.lit(inits - 1))).alias("seed"))
    drawn = drawn.withColumn("h", F.xxhash64(F.col("seed") + seed, "key"))
    drawn = drawn.where(F.pmod("h", F.lit(1 << 31)) < F.col("share") * (1 << 31)).select("part", "seed", "k", "h", "x")

    def choose(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("h")
        x, k = np.stack(frame["x"].to_numpy()).astype(float), int(frame["k"].iloc[0])
        rng = np.random.default_rng([seed, int(frame["seed"].iloc[0])])
        picked = [int(rng.integers(len(x)))]
        far = ((x - x[picked[0]]) ** 2).sum(1)
        while len(picked) < k and far.max() > 0:
            picked.append(int(np.searchsorted(np.cumsum(far), rng.random() * far.sum(), "right").clip(0, len(x) - 1)))
            far = np.minimum(far, ((x - x[picked[-1]]) ** 2).sum(1))
        place = {"part": frame["part"].iloc[0], "seed": frame["seed"].iloc[0]}
        return pd.DataFrame({**place, "cluster": range(len(picked)), "centre": list(x[picked])})

    schema = "part string, seed int, cluster int, centre array<double>"
    found: dict[str, dict] = {}
    for r in drawn.groupBy("part", "seed").applyInPandas(choose, schema).collect():
        found.setdefault(r["part"], {})[r["seed"], r["cluster"]] = r["centre"]
    centres = {}
    for part, entries in found.items():
        clusters = 1 + max(c for _, c in entries)
        # A seed that finds fewer different rows repeats its first centre, which then wins every tie.
        centres[part] = np.array([[entries.get((s, c), entries[s, 0]) for c in range(clusters)] for s in range(inits)])
    return centres


def kmeans_centres(rows: DataFrame, targets: DataFrame, seed: int = 42, inits: int = 10, iterations: int = 20) -> dict[str, np.ndarray]:
    """Centres (seed, cluster, entry) of every part with k > 1 after up to ``iterations`` steps for all parts and seeds.

    ``rows``: part, key, x; ``targets``: part, k, size. Parts of which all centres stand still (moved less than 1e-4)
    leave the iteration. The centres are on the driver between steps: sum of k x ``inits`` vectors, so callers bound the
    sum of k, here by the sample size.
    """
    moving = _first_centres(rows, targets.where("k > 1"), seed, inits)
    still: dict[str, np.ndarray] = {}
    for _ in range(iterations):
        if not moving:
            break
        new = {name: c.copy() for name, c in moving.items()}
        for r in lloyd_step(rows, moving).collect():
            new[r["part"]][r["seed"], r["cluster"]] = r["centre"]
        settled = [name for name in moving if np.abs(new[name] - moving[name]).max() < 1e-4]
        still |= {name: new[name] for name in settled}
        moving = {name: c for name, c in new.items() if name not in settled}
    return still | moving


def medoids(rows: DataFrame, centres: dict[str, np.ndarray]) -> DataFrame:
    """(part, key): the row nearest to the centre of each non-empty cluster, for the seed with the least cost of its part.

    Parts without centres have one, their mean 0. Ties go to the smaller key and seed.
    """
    shared = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x, keys = matrix(batch.column("x")), batch.column("key").to_numpy(zero_copy_only=False)
            for name, mine in _grouped(batch):
                c = shared.value.get(name, np.zeros((1, 1, x.shape[1])))
                if name not in best:
                    best[name] = (np.full(c.shape[:2], np.inf), np.full(c.shape[:2], None, object), np.zeros(len(c)))
                near, who, cost = best[name]
                chosen, far = _nearest_centres(x[mine], c)
                cost += far.sum(0)
                rounded = np.round(far, 9)
                for s in range(len(c)):
                    order = np.lexsort((keys[mine].astype(str), rounded[:, s], chosen[:, s]))
                    cluster, first = np.unique(chosen[order, s], return_index=True)
                    d, k = rounded[order[first], s], keys[mine[order[first]]]
                    old_d, old_k = near[s, cluster], who[s, cluster]
                    better = (d < old_d) | (d == old_d) & np.array([o is None or n < o for n, o in zip(k, old_k, strict=True)], bool)
                    near[s, cluster[better]], who[s, cluster[better]] = d[better], k[better]
        for name, (near, who, cost) in best.items():
            seed, cluster = np.nonzero(np.isfinite(near))
            # A seed's cost travels with its first cluster of the task.
            lead = np.append(True, seed[1:] != seed[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(seed), pa.string()), pa.array(seed.astype(np.int32)), pa.array(cluster.astype(np.int32)),
                 pa.array(np.where(lead, cost[seed], 0.0)), pa.array(near[seed, cluster]), pa.array(who[seed, cluster].tolist(), pa.string())],
                ["part", "seed", "cluster", "cost", "d", "key"],
            )

    ship(rows.sparkSession)
    parts = rows.select("part", "key", "x").mapInArrow(run, "part string, seed int, cluster int, cost double, d double, key string")
    merged = parts.groupBy("part", "seed", "cluster").agg(F.sum("cost").alias("cost"), F.min(F.struct("d", "key")).alias("first"))
    merged = checkpoint(merged)
    costs = merged.groupBy("part", "seed").agg(F.sum("cost").alias("cost"))
    best = costs.groupBy("part").agg(F.min(F.struct(F.round("cost", 9), "seed")).alias("best"))
    wanted = best.select("part", F.col("best.seed").alias("seed"))
    return merged.join(wanted, ["part", "seed"]).select("part", F.col("first.key").alias("key"))


def kmeans_sample(
    df: DataFrame, strata: Sequence[str], features: Sequence[str], keys: Sequence[str],
    sample_size: int = CLUSTER_SAMPLE_SIZE, seed: int = 42, inits: int = 10, iterations: int = 20,
    top_up: str | None = None,
) -> DataFrame:
    """One row for each of ``target`` clusters of every stratum: the row nearest to the cluster's centre.

    All rows take part; ``presample_large_groups`` is there for callers that want fewer. All strata and ``inits`` seeds
    go through the same steps together, whatever their number; the seed with the least cost of a stratum counts. Strata of
    one target give the row nearest to their mean. ``keys`` identify the rows. Centres that travel to the tasks:
    at most 1.5 x ``sample_size`` x ``inits`` vectors.
    """
    targets = cluster_targets(df, strata, sample_size)
    if df.isEmpty():
        return df
    counts = category_counts(df, strata).select(stratum_name(strata).alias("part"), F.col("count").alias("size"))
    targets = targets.select(stratum_name(strata).alias("part"), F.col("target").alias("k")).join(counts, "part")
    name = F.to_json(F.array(*[col(k).cast("string") for k in keys]))
    rows = scaled_in_stratum(df, strata, features).select(stratum_name(strata).alias("part"), name.alias("key"), F.col("_x").alias("x"))
    rows = written(rows, "kmeans")
    centres = kmeans_centres(rows, checkpoint(targets), seed, inits, iterations)
    chosen = checkpoint(medoids(rows, centres).select("key"))
    picked = df.withColumn("_name", name).join(small(chosen).withColumnRenamed("key", "_name"), "_name", "left_semi")
    sample = checkpoint(picked.select(*[col(c) for c in df.columns]))
    return sample if top_up is None else top_up_rare_classes(df, sample, top_up, keys, seed)


def stratum_moments(scored: DataFrame, strata: Sequence[str]) -> DataFrame:
    """(part, i, j, value, rows): the mean products of the entries i <= j of ``_x`` in every stratum, part being its name.

    One aggregate for all strata: tasks add up matrix products, entries of equal place are added after a shuffle.
    """
    ship(scored.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list] = {}
        width = 1
        for batch in batches:
            if not batch.num_rows:
                continue
            x, parts = matrix(batch.column("_x")), batch.column("part").dictionary_encode()
            codes, width = parts.indices.to_numpy(zero_copy_only=False), x.shape[1]
            for code, name in enumerate(parts.dictionary.to_pylist()):
                mine = x[codes == code]
                old = sums.setdefault(name, [np.zeros((width, width)), 0])
                old[0] += mine.T @ mine
                old[1] += len(mine)
            if len(sums) * width * width > MOMENTS_HELD:
                yield _listed(sums, width)
                sums = {}
        if sums:
            yield _listed(sums, width)

    named = scored.select(stratum_name(strata).alias("part"), "_x")
    parts = named.mapInArrow(run, "part string, i int, j int, total double, rows long")
    total = parts.groupBy("part", "i", "j").agg(F.sum("total").alias("total"), F.sum("rows").alias("rows"))
    return total.select("part", "i", "j", (F.col("total") / F.col("rows")).alias("value"), "rows")


def _listed(sums: dict[str, list], width: int) -> pa.RecordBatch:
    i, j = np.triu_indices(width)
    n = len(sums)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array(list(sums), object), len(i)), pa.string()),
            pa.array(np.tile(i, n).astype(np.int32)), pa.array(np.tile(j, n).astype(np.int32)),
            pa.array(np.concatenate([m[i, j] for m, _ in sums.values()])),
            pa.array(np.repeat([rows for _, rows in sums.values()], len(i))),
        ],
        ["part", "i", "j", "total", "rows"],
    )


def stratum_name(strata: Sequence[str]) -> Column:
    """The stratum as one string, different for different values, nulls included."""
    return F.to_json(F.array(*[col(s).cast("string") for s in strata]))


def stratum_axes(scored: DataFrame, strata: Sequence[str]) -> DataFrame:
    """(part, rows, axes): directions of every stratum, all that carry variance, with the width of a grid cell.

    These are the principal directions. Where variances differ by less than their sampling error, the data do not tell their
    directions apart; there the features' own directions are taken, as far as they lie in the same space. An axis is
    (direction, width); the width follows Scott's rule, 3.49 deviations over rows^(1 / (axes + 2)). Each stratum's matrix
    is handled in a task.
    """

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = frame["i"].to_numpy(), frame["j"].to_numpy()
        gram = np.zeros((j.max() + 1,) * 2)
        gram[i, j] = gram[j, i] = frame["value"]
        values, vectors = (x[..., ::-1] for x in np.linalg.eigh(gram))
        rows = int(frame["rows"].iloc[0])
        values = values[values > LEAST_VARIANCE]
        apart = np.flatnonzero(values[:-1] - values[1:] > 4 * values[:-1] * np.sqrt(2 / rows)) + 1
        chosen = []
        for group in np.split(np.arange(len(values)), apart):
            space = vectors[:, group] @ vectors[:, group].T
            for _ in group:
                feature = int(np.round(np.diag(space), 9).argmax())
                axis = space[:, feature] / np.sqrt(space[feature, feature])
                chosen.append(axis)
                space = space - np.outer(axis, axis)
        deviations = [float(np.sqrt(v @ gram @ v)) for v in chosen]
        factor = 3.49 / rows ** (1.0 / (len(chosen) + 2))
        axes = [{"direction": v.tolist(), "width": factor * s} for v, s in zip(chosen, deviations, strict=True)]
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "rows": [rows], "axes": [axes]})

    moments = stratum_moments(scored, strata)
    return moments.groupBy("part").applyInPandas(solve, "part string, rows long, axes array<struct<direction:array<double>,width:double>>")


def grid_clusters(
    placed: DataFrame, min_rows: int = MIN_CLUSTER_ROWS, max_min_rows: int = MAX_MIN_CLUSTER_ROWS
) -> DataFrame:
    """``placed`` (part, rows, cell array<long> and others) with ``cluster``; null marks noise.

    Cells holding at least the mean number of rows of the occupied cells of their part, and two, are dense; dense cells
    of a part whose numbers differ by at most one in every direction touch and are in one cluster, named after its
    smallest cell. Clusters below ``max(min_rows, min(max_min_rows, rows // 100))`` rows are noise. Rows are only ever
    counted per cell. Touching cells are found among the occupied ones, in balls around pivots, so neither the number
    of directions nor a hot cell multiplies the work.
    """
    cells = placed.groupBy("part", "cell").agg(F.count(F.lit(1)).alias("n"), F.first("rows").alias("rows"))
    means = cells.groupBy("part").agg(F.avg("n").alias("mean"))
    dense = cells.join(small(checkpoint(means)), "part").where(F.col("n") >= F.greatest(F.lit(2.0), F.col("mean")))
    name = F.concat("part", F.lit("|"), F.array_join("cell", "_"))
    dense = checkpoint(dense.select("part", "cell", "n", "rows", name.alias("key")))
    width = dense.select(F.max(F.size("cell"))).first()[0]
    if width is None:
        return placed.withColumn("cluster", F.lit(None).cast("string"))
    # Parts may have different numbers of directions.
    filled = F.concat("cell", F.array_repeat(F.lit(0).cast("long"), F.lit(max(width, 1)) - F.size("cell")))
    edges = BallIndex(dense.withColumn("vector", filled.cast("array<double>")), "chebyshev").touching(1.0)
    members = connected_components(edges, "a", "b").withColumnRenamed("node", "key")
    assigned = dense.join(members, "key", "left").withColumn("component", F.coalesce("component", "key"))
    least = F.greatest(F.lit(min_rows), F.least(F.lit(max_min_rows), F.floor(F.col("rows") / 100)))
    sizes = assigned.groupBy("component").agg(F.sum("n").alias("size"), F.first("rows").alias("rows"))
    large = sizes.where(F.col("size") >= least).select("component")
    kept = assigned.join(large, "component", "left_semi")
    kept = kept.select("part", "cell", F.expr("substring(component, length(part) + 2)").alias("cluster"))
    return placed.join(small(checkpoint(kept)), ["part", "cell"], "left")


def density_clusters(
    scored: DataFrame, strata: Sequence[str], keys: Sequence[str],
    min_rows: int = MIN_CLUSTER_ROWS, max_min_rows: int = MAX_MIN_CLUSTER_ROWS, turned: bool = True,
) -> DataFrame:
    """(strata..., keys..., cluster): density clusters inside each stratum; null marks noise.

    One density level instead of a hierarchy, by a grid: the rows of a stratum are measured along its own
    directions (``stratum_axes``) and counted in cells (``grid_clusters``). With ``turned`` off the grid follows the
    features instead, whose deviation is 1. A stratum without variance is one cell.
    """
    if not turned:
        part = stratum_name(strata)
        sizes = scored.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
        width = 3.49 / F.pow(F.col("rows").cast("double"), 1.0 / (F.size("_x") + 2))
        # Rounded, so that the last digit of a sum does not move a row into the next cell.
        cell = F.transform("_x", lambda x: F.floor(F.round(x / width, 9)))
        placed = scored.withColumn("part", part).join(small(checkpoint(sizes)), "part").withColumn("cell", cell)
        placed = checkpoint(placed.select(*[col(c) for c in [*strata, *keys]], "part", "rows", "cell"))
        return grid_clusters(placed, min_rows, max_min_rows).select(*[col(c) for c in [*strata, *keys]], "cluster")
    axes = checkpoint(stratum_axes(scored, strata))
    width = axes.select(F.max(F.size("axes"))).first()[0] or 0
    # A row of the table holds the square of the features' number in doubles: sent to all tasks only while it is small.
    axes = F.broadcast(axes) if axes.count() * width * width <= AXES_SENT else axes
    along = lambda a: F.aggregate(F.zip_with("_x", a["direction"], lambda x, v: x * v), F.lit(0.0), lambda s, x: s + x)
    cell = F.transform("axes", lambda a: F.floor(along(a) / a["width"]))
    placed = scored.withColumn("part", stratum_name(strata)).join(axes, "part").withColumn("cell", cell)
    placed = checkpoint(placed.select(*[col(c) for c in [*strata, *keys]], "part", "rows", "cell"))
    return grid_clusters(placed, min_rows, max_min_rows).select(*[col(c) for c in [*strata, *keys]], "cluster")


def density_quotas(clusters: DataFrame, targets: DataFrame, strata: Sequence[str]) -> DataFrame:
    """(strata..., cluster, quota): proportional per cluster, noise fills the rest, never above the target.

    A cluster gets max(1, whole part of its share); clusters come in name order until the target is full.
    """
    stratum = [col(s) for s in strata]
    sizes = clusters.groupBy(*stratum, "cluster").agg(F.count(F.lit(1)).alias("_size"))
    total = sizes.groupBy(*stratum).agg(F.sum("_size").alias("_rows"))
    planned = join_on(join_on(sizes, total, strata), targets, strata)
    share = F.greatest(F.lit(1), F.floor(F.col("_size") / F.col("_rows") * F.col("target")))
    wanted = F.when(F.col("cluster").isNull(), F.col("_size")).otherwise(F.least(share, F.col("_size")))
    planned = planned.withColumn("_wanted", wanted)
    # One row per cluster of a stratum; noise last.
    before = Window.partitionBy(*stratum).orderBy(F.col("cluster").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    used = F.coalesce(F.sum("_wanted").over(before), F.lit(0))
    free = F.greatest(F.lit(0), F.col("target") - used)
    return planned.withColumn("quota", F.least("_wanted", free)).select(*stratum, "cluster", "quota")


def density_sample(
    df: DataFrame, strata: Sequence[str], features: Sequence[str], keys: Sequence[str],
    sample_size: int = CLUSTER_SAMPLE_SIZE, seed: int = 42, top_up: str | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Sample every stratum in proportion to its density clusters; noise fills up what is missing."""
    targets = cluster_targets(df, strata, sample_size)
    if df.isEmpty():
        return df
    clusters = checkpoint(density_clusters(scaled_in_stratum(df, strata, features), strata, keys))
    quotas = density_quotas(clusters, targets, strata)
    labelled = join_on(df, clusters.select(*[col(k) for k in keys], "cluster"), keys)
    sample = pick(labelled, [*strata, "cluster"], quotas, keys, seed, max_group_rows)
    sample = checkpoint(sample.select(*[col(c) for c in df.columns]))
    return sample if top_up is None else top_up_rare_classes(df, sample, top_up, keys, seed)
