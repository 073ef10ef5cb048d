"""Near-duplicate groups: one-permutation hashing, banded buckets and star-shaped candidate edges."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.aggregates import small
from tabscope.llm.arrays import LOWER, U64, Rolling, joined, mix, odd_weights, per_text, pieces, tidy, utf8, with_columns, words
from tabscope.llm.frames import batched, stored, with_names
from tabscope.llm.graph import components


@dataclass(frozen=True)
class Shape:
    """Shingle length in words, share of shingles in percent that links two texts, bands and rows of a band.

    Two texts at the limit of 80 % share no band of 32 with 4 rows with probability (1 - 0.8^4)^32 < 1e-7.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4

    def __post_init__(self) -> None:
        if self.bands * self.rows & (self.bands * self.rows - 1):
            raise ValueError("bands * rows must be a power of two")


def shingle_sets(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each text, sorted within the text, and their offsets by text."""
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    word = Rolling(LOWER[data]).of(starts, ends)
    weights = odd_weights(length)
    whole = joined(word, weights)
    inside = owner[: len(whole)] == owner[length - 1 :] if len(whole) else np.zeros(0, bool)
    counts = per_text(owner, n)
    first = np.zeros(n + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    short = np.flatnonzero((counts > 0) & (counts < length))
    single = np.zeros(len(short), U64)
    for k in range(length - 1):
        has = counts[short] > k
        single[has] += word[first[short[has]] + k] * U64(weights[k])
    single = mix(single + U64(length) + counts[short].astype(U64))
    values = np.concatenate([whole[inside], single])
    texts = np.concatenate([owner[: len(whole)][inside], short])
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(texts[order].astype(np.uint16 if n <= 1 << 16 else np.int64), kind="stable")]
    values, texts = values[order], texts[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    values, texts = values[keep], texts[keep]
    bounds = np.zeros(n + 1, np.int64)
    np.cumsum(per_text(texts, n), out=bounds[1:])
    return values, bounds


def signatures(values: np.ndarray, bounds: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """One-permutation signatures of the non-empty sets, and which sets these are.

    A shingle falls into the bin of its leading bits; a bin keeps its smallest shingle. An empty bin borrows from
    the bin that a hash of (bin, attempt) names, with further attempts until one is not empty (optimal
    densification: the choice does not depend on the set, and borrowed bins are independent of one another).
    """
    sets = np.flatnonzero(np.diff(bounds))
    bits = bins.bit_length() - 1
    row = np.repeat(np.arange(len(sets)), np.diff(bounds)[sets])
    bin_of = (values >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    cell = row * bins + bin_of
    lead = np.ones(len(cell), bool)
    lead[1:] = cell[1:] != cell[:-1]
    found = np.zeros(len(sets) * bins, U64)
    full = np.zeros(len(sets) * bins, bool)
    found[cell[lead]] = values[lead]
    full[cell[lead]] = True
    out = found.copy()
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        attempt += 1
        choice = mix((np.arange(bins, dtype=U64) << U64(32)) + U64(attempt)) & U64(bins - 1)
        source = empty // bins * bins + choice.astype(np.int64)[empty % bins]
        ready = full[source]
        out[empty[ready]] = found[source[ready]]
        empty = empty[~ready]
    return out.reshape(len(sets), bins), sets


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.tile(np.arange(1, bands + 1, dtype=U64), (len(signature), 1))
    for k, weight in enumerate(odd_weights(rows)):
        keys += signature.reshape(len(signature), bands, rows)[:, :, k] * U64(weight)
    return mix(keys).view(np.int64)


def _digests(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits that depend on the whole set: two sums of mixed shingles and the size."""
    out = np.zeros((len(bounds) - 1, 2), U64)
    for k in range(2):
        sums = np.zeros(len(values) + 1, U64)
        np.cumsum(mix(values + U64(0xA5A5 + k)), out=sums[1:])
        out[:, k] = mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(U64))
    return out


def _described(text_col: str, shape: Shape, give: str, keep_text: bool = False):
    """Size and digest of each text's set, and its ``bands``, its ``set`` or neither (``digest``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text_col):
            values, bounds = shingle_sets(*utf8(part.column(text_col)), shape.shingle)
            digest = pa.array([d.tobytes() for d in _digests(values, bounds)], pa.binary())
            extra = {"__n": pa.array(np.diff(bounds)), "__node": digest}
            if give == "set":
                extra["__set"] = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))
            elif give == "bands":
                signature, rows = signatures(values, bounds, shape.bands * shape.rows)
                ends = np.zeros(len(bounds), np.int64)
                np.cumsum(np.where(np.diff(bounds) > 0, shape.bands, 0), out=ends[1:])
                keys = band_keys(signature, shape.bands, shape.rows).ravel()
                extra["__bands"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys))
            yield with_columns(part, extra, () if keep_text else (text_col,))

    return tidy(run)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets overlap enough; sizes alone rule out most others before sets are moved."""
    size = sets.select("__node", "__n")
    for side in ("a", "b"):
        pairs = pairs.join(size.select(F.col("__node").alias(side), F.col("__n").alias(f"n{side}")), side)
    pairs = pairs.where(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("__node").alias(side), F.col("__set").alias(f"s{side}")), side)
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.where(100 * common >= percent * (F.col("na") + F.col("nb") - common)).select("a", "b")


def _with_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    labels = labels.withColumnRenamed("node", "__node")
    return members.join(labels, "__node", "left").withColumn("label", F.coalesce("label", "__node"))


def _prefixes(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Buckets (``key``, ``__node``, ``__n``, ``weight``, ``at``, ``indexed``) by shared rare shingles.

    With all shingles in one order, rarest first, two linked sets meet in the first n - ceil(p n) + 1 shingles of
    the larger and, as its overlap must reach 2 p / (1 + p) of the mean size, in the first
    n - ceil(2 p n / (1 + p)) + 1 of the smaller: its ``indexed`` part. So no link escapes, and copies with edits of
    their own, which have those edits in front, meet nobody.
    """
    shingles = sets.join(nodes, "__node").select("__node", "__n", "weight", F.explode("__set").alias("key"))
    counts = shingles.groupBy("key").agg(F.count(F.lit(1)).alias("holders"))
    shingles = shingles.join(counts, "key")
    ranked = shingles.groupBy("__node", "__n", "weight").agg(
        F.sort_array(F.collect_list(F.struct("holders", "key"))).alias("ranked")
    )
    # Integer arithmetic: n - ceil(x / y) + 1 = n + 1 + floor(-x / y)
    length = F.expr(f"CAST(__n + 1 + floor(-{percent} * __n / 100) AS INT)")
    rare = ranked.select("__node", "__n", "weight", F.posexplode(F.slice("ranked", F.lit(1), length)).alias("at", "s"))
    indexed = F.expr(f"at < __n + 1 + floor(-{2 * percent} * __n / {100 + percent})")
    rare = rare.where("s.holders > 1").select(
        F.col("s.key").alias("key"), "__node", "__n", "weight", "at", indexed.alias("indexed")
    )
    # What is left of a set from its place on must reach the overlap with the smallest indexed set of the bucket.
    least = rare.where("indexed").groupBy("key").agg(F.min("__n").alias("least"))
    rare = rare.join(least, "key").where(f"indexed OR {100 + percent} * (__n - at) >= {percent} * (__n + least)")
    crowd = rare.groupBy("key").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    return rare.drop("least").join(crowd.select("key"), "key", "left_semi")


def _closed(members: DataFrame, labels: DataFrame, tested: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``labels`` after all links within the buckets of ``members``.

    Each bucket that holds several components gets centres, eight times as many a round, among its indexed members,
    each compared with the members outside its component, until all have been centres or one component is left.
    Two members that are only in the longer part of the order need no comparison in this bucket.
    """
    members = stored(members, "rare")
    used = members.select("key", "__node").limit(0)
    centres = 8
    while True:
        here = _with_labels(members, labels)
        fresh = here.where("indexed").join(used, ["key", "__node"], "left_anti")
        parts = here.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        open_keys = fresh.select("key").distinct().join(parts, "key", "left_semi")
        here = stored(here.join(open_keys, "key", "left_semi"), "open")
        if here.isEmpty():
            return labels
        fresh = here.where("indexed").join(used, ["key", "__node"], "left_anti")
        place = "row_number() OVER (PARTITION BY key ORDER BY weight DESC, __node DESC) AS place"
        chosen = stored(fresh.selectExpr("*", place).where(F.col("place") <= centres).drop("place"), "centres")
        now = chosen.selectExpr("key", "__node AS centre", "label AS centre_label", "__n AS centre_n", "at AS centre_at")
        # A pair meets at its first common shingle, from which enough must be left of both sets.
        enough = f"{100 + percent} * least(__n - at, centre_n - centre_at) >= {percent} * (__n + centre_n)"
        new = here.join(now, "key").where("label <> centre_label").where(enough)
        new = new.where("indexed OR struct(centre_n, centre) < struct(__n, __node)")
        new = new.select(F.least("centre", "__node").alias("a"), F.greatest("centre", "__node").alias("b")).distinct()
        new = stored(new.join(tested, ["a", "b"], "left_anti"), "pairs")
        found = stored(_confirmed(new, sets, percent), "links")
        if not found.isEmpty():
            ends = _with_labels(found.withColumnRenamed("a", "__node"), labels).withColumnRenamed("label", "u")
            ends = _with_labels(ends.drop("__node").withColumnRenamed("b", "__node"), labels)
            merged = components(ends.select(F.col("u").alias("a"), F.col("label").alias("b")))
            everyone = found.select(F.explode(F.array("a", "b")).alias("node")).unionAll(labels.select("node")).distinct()
            everyone = _with_labels(everyone.withColumnRenamed("node", "__node"), labels)
            to = merged.select(F.col("node").alias("label"), F.col("label").alias("to"))
            labels = stored(
                everyone.join(to, "label", "left").select(
                    F.col("__node").alias("node"), F.coalesce("to", "label").alias("label")
                ),
                "labels",
            )
        tested = tested.unionAll(new)
        used = used.unionAll(chosen.select("key", "__node"))
        centres *= 8


def _components(ids: DataFrame, shape: Shape) -> DataFrame:
    """``__id``, ``__n``, ``__node``, ``component`` and the group's ``label`` for every row of ``ids`` (``__id``, ``__text``)."""
    kind = ids.schema["__id"].dataType.simpleString()
    out = with_names([], f"__id {kind}, __n long, __node binary, __bands array<long>")
    rows = stored(batched(ids).mapInArrow(_described("__text", shape, "bands"), out), "signatures")
    nodes = rows.where("__n > 0").groupBy("__node").agg(F.first("__bands").alias("__bands"))
    members = nodes.select("__node", F.explode("__bands").alias("key"))
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = stored(members.join(shared, "key"), "buckets")
    typical = members.groupBy("__node").agg(F.sum("size").alias("weight"))
    members = stored(members.select("key", "__node").join(typical, "__node"), "buckets")

    wanted = typical.select("__node")
    set_out = with_names([], f"__id {kind}, __n long, __node binary, __set array<long>")
    first = rows.join(wanted, "__node", "left_semi").groupBy("__node").agg(F.min("__id").alias("__id"))
    texts = ids.join(first.select("__id").distinct(), "__id", "left_semi")
    sets = batched(texts).mapInArrow(_described("__text", shape, "set"), set_out)
    orphans = first.where("__id IS NULL")
    if not orphans.isEmpty():
        bare = batched(ids.where("__id IS NULL")).mapInArrow(_described("__text", shape, "set"), set_out)
        sets = sets.unionAll(bare)
    sets = sets.join(wanted, "__node", "left_semi").groupBy("__node", "__n").agg(F.first("__set").alias("__set"))
    sets = stored(sets, "sets")

    best = F.max_by("__node", F.struct("weight", "__node")).alias("centre")
    stars = members.groupBy("key").agg(best)
    pair = (F.least("centre", "__node").alias("a"), F.greatest("centre", "__node").alias("b"))
    tested = members.join(stars, "key").where("centre <> __node").select(*pair).distinct()
    tested = stored(tested, "pairs")
    links = stored(_confirmed(tested, sets, shape.percent), "links")
    labels = components(links)
    labelled = _with_labels(members, labels).join(stars, "key").where("centre <> __node")
    parts = labelled.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_keys = parts.where("low <> high").select("key")
    rest = labelled.join(open_keys, "key", "left_semi").groupBy("__node").agg(F.first("weight").alias("weight"))
    rest = stored(rest, "open")
    if not rest.isEmpty():
        labels = _closed(_prefixes(sets, rest, shape.percent), labels, tested, sets, shape.percent)

    labels = labels.withColumnRenamed("node", "__node")
    of_node = rows.where("__n > 0").groupBy("__node").agg(F.min("__id").alias("low"))
    of_node = of_node.join(labels, "__node", "left").withColumn("label", F.coalesce("label", "__node"))
    lowest = of_node.groupBy("label").agg(F.min("low").alias("component"))
    of_node = of_node.join(lowest, "label").select("__node", "component", "label")
    grouped = rows.where("__n > 0").join(of_node, "__node")
    alone = rows.where("__n = 0").withColumn("component", F.col("__id")).withColumn("label", F.col("__node"))
    columns = ("__id", "__n", "__node", "component", "label")
    return grouped.select(*columns).unionAll(alone.select(*columns))


def _kept() -> Column:
    return F.coalesce(F.col("__id") == F.col("component"), F.col("component").isNull())


def near_duplicates(
    docs: DataFrame, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Id, ``n_shingles``, ``component_id`` and ``kept`` for every row of ``docs``.

    Words are split at ASCII white space and A-Z lower-cased. A text with fewer words than a shingle has them as
    its only shingle; null, empty and blank texts have none and are linked with nothing. Two rows are linked when
    their sets share ``percent`` of their union, ``component_id`` is the smallest id reachable over links, and the
    row with that id is kept. Rows with equal sets are one node, so copies cost nothing beyond their own row.
    Repeated ids are separate rows. A null id is never a ``component_id``: such a row is kept only if no row with
    an id is linked with it. An empty table gives an empty table.

    In each bucket the member in the largest buckets overall (the most typical one) becomes the centre of a star;
    every other member is compared with it, so pairs grow with the bucket. Members of buckets that then still
    hold several components are compared once more through their rarest shingles, which loses no link.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return _components(rows, shape).select(
        F.col("__id").alias(id_col),
        F.col("__n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        _kept().alias("kept"),
    )


def without_duplicates(
    docs: DataFrame, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` that are kept, one of each group, with all columns.

    Rows are named by id and set, so that of rows with the same id only those in another group go. Several rows of
    one group with the smallest id are one document: one of them stays. Rows without an id that are linked
    with none that has one all stay. The rows that go are narrow, and broadcast while they are few; the texts
    move only when they are many.
    """
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_at, text_at = (f"c{names.index(c)}" for c in (id_col, text_col))
    ids = plain.select(F.col(id_at).alias("__id"), F.col(text_at).alias("__text"))
    decided = stored(_components(ids, shape).withColumn("kept", _kept()), "decided")
    gone = decided.where("NOT kept").select("__id", "__node").distinct()
    gone = stored(gone.withColumnsRenamed({"__id": "g_id", "__node": "g_node"}), "gone")
    schema = with_names(plain.schema, "__n long, __node binary")
    rows = batched(plain).mapInArrow(_described(text_at, shape, "digest", keep_text=True), schema)
    left = rows.join(small(gone), rows[id_at].eqNullSafe(gone["g_id"]) & (rows["__node"] == gone["g_node"]), "left_anti")
    same = decided.where("kept AND __n > 0 AND __id IS NOT NULL").groupBy("__id", "label")
    same = same.agg(F.count(F.lit(1)).alias("n"), F.min("__node").alias("first")).where("n > 1").drop("n")
    twice = decided.join(same, ["__id", "label"]).selectExpr("__id AS t_id", "__node AS t_node", "__node = first AS stays")
    twice = stored(twice.distinct(), "twice")
    if not twice.isEmpty():
        meets = (left[id_at] == twice["t_id"]) & (left["__node"] == twice["t_node"])
        place = f"row_number() OVER (PARTITION BY t_id, t_node ORDER BY xxhash64({text_at}), {text_at}) AS place"
        one = left.join(small(twice.where("stays")), meets).selectExpr("*", place).where("place = 1")
        left = left.join(small(twice), meets, "left_anti").unionAll(one.select(*left.columns))
    return left.drop("__n", "__node").toDF(*names)
