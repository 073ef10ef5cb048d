"""Groups of spelling variants: words one edit apart, found with k-d trees over their letter counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.arrays import utf8
from tabscope.llm.frames import batched, stored
from tabscope.llm.kdtree import KdTree
from tabscope.llm.urls import LOWER, UPPER

LETTERS = "[A-Za-zÀ-ÿ]+"
SHORTEST, LEAST, RATIO = 7, 2, 10
# Words of one length that a task searches at once, on average, and the bounds of the sample that the regions are cut by.
CELL, SAMPLE, SAMPLE_LETTERS = 20_000, 100_000, 64
# Letter counts above this are told apart by the letters alone.
MOST = 250


def runs_of_letters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``word`` for every maximal run of A-Z, a-z and U+00C0 to U+00FF of at least ``SHORTEST`` letters, with
    A-Z in lower case. Null texts have none."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"))
    return rows.where(F.char_length("run") >= SHORTEST).select("doc_id", F.translate("run", UPPER, LOWER).alias("word"))


def slipped(doc_id: Column, word: Column) -> Column:
    """``word``, without the letter at h % length where 31 divides h, the crc32 of ``doc_id:word`` (null id: empty)."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), word).cast("binary"))
    at = (h % F.char_length(word)).cast("int")
    return F.when(h % 31 == 0, F.concat(F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.char_length(word)))).otherwise(word)


def word_counts(words: DataFrame) -> DataFrame:
    """``word`` and ``n`` of the words with at least ``SHORTEST`` letters and ``LEAST`` occurrences; combined before the shuffle."""
    counts = words.where(F.char_length("word") >= SHORTEST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= LEAST)


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words as one byte a letter (its code point), behind each other, and their bounds."""
    data, offsets = utf8(words)
    lead = data == 0xC3
    codes = data.copy()
    codes[1:][lead[:-1]] += 0x40
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~lead, out=before[1:])
    return codes[~lead], before[offsets]


def counted(codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Letter counts: a column for each of a to z and U+00C0 to U+00FF."""
    n = len(bounds) - 1
    column = np.where(codes < 128, codes.astype(np.int64) - ord("a"), codes.astype(np.int64) - 0xC0 + 26)
    found = np.bincount(np.repeat(np.arange(n), np.diff(bounds)) * 90 + column, minlength=n * 90)
    return np.minimum(found, MOST).reshape(n, 90).astype(np.int16)


def _one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether rows of letters, equally long or one longer on the right, are one edit apart."""
    width = short.shape[1]
    ahead = np.append(short != long[:, :width], np.ones((len(short), 1), bool), 1).argmax(1)
    behind = np.append((short != long[:, long.shape[1] - width :])[:, ::-1], np.ones((len(short), 1), bool), 1).argmax(1)
    return (ahead < long.shape[1]) & (ahead + behind >= long.shape[1] - 1)


class _Cell:
    """The words of one length in one region, under a k-d tree once they are complete."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.words: list[pa.Array] = []
        self.sizes: list[pa.Array] = []
        self.tree: KdTree | None = None

    def _search(self, words: pa.Array, sizes: pa.Array, rows: np.ndarray, vectors: np.ndarray, among: bool) -> Iterator[pa.RecordBatch]:
        width = rows.shape[1]
        for q, p in self.tree.pairs(vectors, 1, 1 if width == self.length else 0):
            if among:
                q, p = q[q < p], p[q < p]
            for at in range(0, len(q), step := max(1, (1 << 22) // self.length)):
                a, b = q[at : at + step], p[at : at + step]
                near = _one_edit(rows[a], self.rows[b])
                a, b = pa.array(a[near]), pa.array(b[near])
                if len(a):
                    mine, other = words.take(a), self.all_words.take(b)
                    columns = ([mine, other], [other, mine], [self.all_sizes.take(b), sizes.take(a)])
                    yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in columns], ["word", "near", "near_n"])

    def close(self) -> Iterator[pa.RecordBatch]:
        """Pairs among the cell's own words, when the last has come."""
        if self.tree is None and self.words:
            self.all_words, self.all_sizes = pa.concat_arrays(self.words), pa.concat_arrays(self.sizes)
            codes, bounds = letters(self.all_words)
            self.rows = codes.reshape(-1, self.length)
            vectors = counted(codes, bounds)
            self.used = vectors.any(0)
            self.tree = KdTree(vectors[:, self.used])
            yield from self._search(self.all_words, self.all_sizes, self.rows, vectors[:, self.used], True)

    def query(self, words: pa.Array, sizes: pa.Array) -> Iterator[pa.RecordBatch]:
        """Pairs of the cell's words with ``words`` from elsewhere, all of one length: the cell's or one less."""
        yield from self.close()
        if self.tree is None:
            return
        codes, bounds = letters(words)
        vectors = counted(codes, bounds)
        width = int(bounds[1])
        # Letters that no word of the cell has: at most one may be replaced, none taken away.
        reach = vectors[:, ~self.used].sum(1) <= (1 if width == self.length else 0)
        some = pa.array(np.flatnonzero(reach))
        yield from self._search(words.take(some), sizes.take(some), codes.reshape(-1, width)[reach], vectors[reach][:, self.used], False)


def _routed(counts: DataFrame, tree: KdTree) -> DataFrame:
    """``counts`` dealt to regions of the tree: each word once as a point (role 0) and as a query wherever a word one edit
    away may lie: with one letter more (any region), or as many (later regions only, so that each pair meets once)."""
    shared = counts.sparkSession.sparkContext.broadcast(tree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            codes, bounds = letters(batch.column("word"))
            vectors, length = counted(codes, bounds), np.diff(bounds)
            home = tree.leaf_of(vectors)
            sent = [(home, length, np.zeros(len(home), np.int32), np.arange(len(home)))]
            for longer, down in ((0, 1), (1, 0)):
                for node, rows in tree.near(vectors, 1, down):
                    leaf = tree.leaf_number[node]
                    rows = rows if longer else rows[home[rows] < leaf]
                    sent.append((np.full(len(rows), leaf, np.int32), length[rows] + longer, np.ones(len(rows), np.int32), rows))
            leaf, size, role, rows = (np.concatenate(c) for c in zip(*sent, strict=True))
            for at in range(0, len(rows), 1 << 15):
                cut = slice(at, at + (1 << 15))
                take = pa.array(rows[cut])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf[cut]), pa.array(size[cut].astype(np.int32)), pa.array(role[cut]), batch.column("word").take(take), batch.column("n").take(take)],
                    ["leaf", "length", "role", "word", "n"],
                )

    return batched(counts).mapInArrow(run, "leaf int, length int, role int, word string, n long")


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, cell = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(k).to_numpy() for k in ("leaf", "length", "role")]
        width = np.diff(letters(batch.column("word"))[1])
        change = np.zeros(batch.num_rows, bool)
        for column in (*keys, width):
            change[1:] |= column[1:] != column[:-1]
        cuts = np.flatnonzero(np.append(np.append(True, change[1:]), True))
        for at, to in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            leaf, length, role = (int(k[at]) for k in keys)
            if key != (leaf, length):
                if cell is not None:
                    yield from cell.close()
                key, cell = (leaf, length), _Cell(length)
            words, sizes = batch.column("word").slice(at, to - at), batch.column("n").slice(at, to - at)
            if role == 0:
                cell.words.append(words)
                cell.sizes.append(sizes)
            else:
                yield from cell.query(words, sizes)
    if cell is not None:
        yield from cell.close()


def regions(counts: DataFrame) -> KdTree:
    """Regions for about ``CELL`` words each, cut by a sample of at most ``SAMPLE`` words picked by hash.

    The sample decides how even the regions are and nothing else.
    """
    total = counts.count()
    picked = counts.where(F.char_length("word") <= SAMPLE_LETTERS).where(F.pmod(F.xxhash64("word"), F.lit(max(1, -(-total // SAMPLE)))) == 0)
    sample = [r[0] for r in picked.select("word").limit(SAMPLE).collect()]
    return KdTree(counted(*letters(pa.array(sample, pa.string()))), leaves=max(1, min(-(-total // CELL), len(sample) // 8)))


def near_words(counts: DataFrame) -> DataFrame:
    """``word``, ``near``, ``near_n`` for every pair of words that differ by exactly one inserted, deleted or replaced letter,
    in both directions.

    One edit changes the letter counts by at most one up and one down, so words are cut into regions of letter counts
    and sent as queries to the regions within that distance. A task goes through its regions and lengths one by one:
    it keeps the words of one length in one region under a k-d tree, streams the queries past it and compares letters
    where the counts are near enough.
    """
    routed = _routed(counts, regions(counts)).repartition("leaf", "length")
    columns = ["leaf", "length", "role"]
    return routed.sortWithinPartitions(*columns, F.char_length("word")).mapInArrow(_paired, "word string, near string, near_n long")


def variants(counts: DataFrame) -> DataFrame:
    """One row per word of ``counts`` (``word``, ``n``, each word once): ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    A word's form is the commonest of the words one edit away (ties: the smallest), if it is at least ``RATIO`` times
    as common; its root is where forms lead in the end. Forms grow by ``RATIO`` a step, so there are no circles and few
    steps, which are doubled each round. Words consist of a to z and U+00C0 to U+00FF. Null words are left out;
    an empty table gives no rows.
    """
    counts = stored(counts.where("word IS NOT NULL").select("word", "n"), "counts")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    found = near_words(counts).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    rows = counts.join(found, "word", "left")
    has_form = -F.col("best.minus") >= RATIO * F.col("n")
    rows = stored(
        rows.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("best.form")).alias("form"), F.when(has_form, -F.col("best.minus")).alias("form_n"),
        ),
        "forms",
    )
    roots = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"), "roots")
        roots = jumped.drop("next")
        if jumped.where("next IS NOT NULL").isEmpty():
            break
    out = rows.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all texts. Null and empty texts have none; repeated rows count again; further columns of
    ``docs`` are ignored."""
    return variants(word_counts(runs_of_letters(docs, id_col, text_col)))
