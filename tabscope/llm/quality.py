"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm.arrays import LOWER, Rolling, pieces, utf8, with_columns, words
from tabscope.llm.frames import batched, crc_part, stored, with_names
from tabscope.llm.perplexity import base_counts

STATISTICS = (
    "log words", "mean word length", "spread of word lengths", "distinct words", "most frequent word", "capitals",
    "digits", "marks", "other punctuation", "white space", "bytes beyond ASCII", "repeated lines", "repeated words",
    "short words", "words without lower case", "log words in a line", "words of letters only", "spread of bytes",
)


def _share(mask: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return np.diff(sums[offsets]) / np.maximum(sizes, 1)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each text; shares are 0 where there is nothing to share."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    starts, ends, owner = words(data, offsets)
    counts = base_counts(data, offsets)
    total = np.maximum(counts["n_words"], 1)
    by_word = lambda values: np.bincount(owner, weights=values, minlength=n) / total
    length = (ends - starts).astype(float)
    mean = by_word(length)
    # Frequency of every distinct word of a text, as runs of equal hashes.
    hashes = Rolling(LOWER[data]).of(starts, ends)
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    lead = np.ones(len(order), bool)
    lead[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    at = np.flatnonzero(lead)
    runs = np.diff(np.append(at, len(order)))
    most = np.zeros(n)
    np.maximum.at(most, owner[order][at], runs)
    lower = ((data >= 97) & (data <= 122)) | (data >= 128)
    upper = (data >= 65) & (data <= 90)
    digit = (data >= 48) & (data <= 57)
    mark = np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    in_word = lambda mask: (s := np.concatenate([[0], np.cumsum(mask)]))[ends] - s[starts]
    lines = _share(data == 10, offsets, np.ones(n)) + 1
    spread = np.zeros(n)
    for low in range(0, 256, 16):
        part = _share((data >= low) & (data < low + 16), offsets, sizes)
        spread -= part * np.log(np.where(part > 0, part, 1))
    return np.column_stack([
        np.log1p(counts["n_words"]), mean, np.sqrt(np.maximum(by_word(length**2) - mean**2, 0)),
        np.bincount(owner[order][at], minlength=n) / total, most / total,
        _share(upper, offsets, sizes), _share(digit, offsets, sizes), _share(mark, offsets, sizes),
        _share(~(lower | upper | digit | mark | blank), offsets, sizes), _share(blank, offsets, sizes),
        _share(data >= 128, offsets, sizes), counts["n_dup_lines"] / lines, counts["n_repeat_words"] / total,
        by_word(length <= 3), by_word(in_word(lower) == 0), np.log1p(counts["n_words"] / lines),
        by_word(in_word(lower | upper) == ends - starts), spread,
    ])


def with_statistics(docs: DataFrame, text_col: str = "text", out: str = "statistics") -> DataFrame:
    """``docs`` without the text, with an array of ``STATISTICS`` of the whole text (null and empty: zeros)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text_col):
            table = statistics(*utf8(part.column(text_col)))
            at = np.arange(0, table.size + 1, table.shape[1], dtype=np.int32)
            yield with_columns(part, {out: pa.ListArray.from_arrays(pa.array(at), pa.array(table.ravel()))}, (text_col,))

    kept = [f for f in docs.schema if f.name != text_col]
    return batched(docs).mapInArrow(run, with_names(kept, f"{out} array<double>"))


@dataclass(frozen=True)
class Kernel:
    """Random Fourier features: cosines of random projections, whose products approximate a Gaussian kernel."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def features(self, table: np.ndarray) -> np.ndarray:
        x = np.clip((table - self.mean) / self.scale, -6, 6)
        waves = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([waves, np.ones(len(x))])


@dataclass(frozen=True)
class Scorer:
    kernel: Kernel
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, table: np.ndarray) -> np.ndarray:
        return self.kernel.features(table) @ self.weights

    def score(self, table: np.ndarray) -> np.ndarray:
        raw = self.raw(table)
        return np.interp(raw, self.knots, self.levels) if len(self.knots) else np.clip(raw, 0, 1)


def _table(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def isotonic(at: np.ndarray, weight: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing means by pooling adjacent violators; knots at the ends of each pool."""
    pools: list[list[float]] = []
    for x, w, t in zip(at.tolist(), weight.tolist(), total.tolist(), strict=True):
        pools.append([x, x, w, t])
        while len(pools) > 1 and pools[-2][3] * pools[-1][2] >= pools[-1][3] * pools[-2][2]:
            _, high, w2, t2 = pools.pop()
            pools[-1] = [pools[-1][0], high, pools[-1][2] + w2, pools[-1][3] + t2]
    knots = np.array([x for low, high, _, _ in pools for x in (low, high)])
    levels = np.array([t / w for _, _, w, t in pools for _ in range(2)])
    return knots, levels


def fit(
    labelled: DataFrame, id_col: str = "doc_id", label_col: str = "quality", features: int = 256, width: float = 4.0,
    ridge: float = 1e-3, seed: int = 7,
) -> Scorer:
    """Fit on rows with ``statistics`` and a 0/1 label: a part of the ids fits the weights, another calibrates.

    Every task sums its share of the normal equations; rows of the sums meet by row number, so the driver gets one
    matrix of ``features`` + 1 rows, whatever the corpus. Calibration pools the mean label of raw scores rounded
    to 1/1000, at most 3001 values. Without labels of one part that part is skipped (weights zero, no calibration).
    """
    labelled = labelled.where(F.col(label_col).isNotNull())
    place = crc_part(F.col(id_col), 6) < 3
    size = len(STATISTICS)
    moments = [f(F.col("statistics")[i]) for i in range(size) for f in (F.avg, F.stddev_pop)]
    found = np.array([v or 0.0 for v in labelled.agg(*moments).first()]).reshape(size, 2)
    random = np.random.default_rng(seed)
    kernel = Kernel(
        found[:, 0], np.where(found[:, 1] > 1e-9, found[:, 1], 1.0),
        random.standard_normal((size, features)) / width, random.uniform(0, 2 * np.pi, features),
    )
    rows = labelled.select("statistics", F.col(label_col).cast("double").alias("y"), place.alias("first"))

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            if batch.num_rows:
                z = kernel.features(_table(batch.column("statistics")))
                y = batch.column("y").to_numpy(zero_copy_only=False)
                total += z.T @ np.column_stack([z, y])
        at = np.arange(0, total.size + 1, features + 2, dtype=np.int32)
        yield pa.RecordBatch.from_pydict({
            "row": pa.array(np.arange(features + 1, dtype=np.int32)),
            "sums": pa.ListArray.from_arrays(pa.array(at), pa.array(total.ravel())),
        })

    def add(group: pa.Table) -> pa.Table:
        sums = np.concatenate([_table(c) for c in group.column("sums").chunks]).sum(0)
        return pa.table({"row": group.column("row").slice(0, 1), "sums": pa.array([sums])})

    kind = "row int, sums array<double>"
    parts = rows.where("first").mapInArrow(equations, kind)
    system = np.zeros((features + 1, features + 2))
    for row in parts.groupBy("row").applyInArrow(add, kind).collect():
        system[row["row"]] = row["sums"]
    gram, target = system[:, :-1], system[:, -1]
    count = max(gram[-1, -1], 1.0)
    weights = np.linalg.solve(gram / count + ridge * np.eye(features + 1), target / count)
    scorer = Scorer(kernel, weights, np.zeros(0), np.zeros(0))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = np.round(np.clip(scorer.raw(_table(batch.column("statistics"))), -1, 2), 3)
                yield pa.RecordBatch.from_pydict({"raw": pa.array(values), "y": batch.column("y")})

    pooled = rows.where(~F.col("first")).mapInArrow(raw, "raw double, y double").groupBy("raw")
    points = pooled.agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y")).orderBy("raw").toPandas()
    knots, levels = isotonic(points["raw"].to_numpy(float), points["n"].to_numpy(float), points["y"].to_numpy(float))
    return Scorer(kernel, weights, knots, levels)


def score(rows: DataFrame, scorer: Scorer, out: str = "score") -> DataFrame:
    """``rows`` with the calibrated score (0 to 1) of their ``statistics``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield with_columns(batch, {out: pa.array(scorer.score(_table(batch.column("statistics"))))})

    return rows.mapInArrow(run, with_names(rows.schema, f"{out} double"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``.

    Labels of ids in the held-out third (crc32 of the id as text, modulo 3, is 1) are never read. Repeated ids are
    scored as separate rows; every pair of a row and a label of its id counts. A null id is held out by its
    empty text like any other and never meets a label.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(with_statistics(rows), "statistics")
    held_out = crc_part(F.col("doc_id")) == 1
    known = labels.select(F.col(id_col).alias("doc_id"), "quality").where(~held_out)
    scorer = fit(rows.join(known, "doc_id"))
    scored = score(rows, scorer)
    return scored.select(
        F.col("doc_id").alias(id_col),
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
