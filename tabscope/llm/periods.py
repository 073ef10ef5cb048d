"""Periodic runs of words: candidates on a harmonic grid, extended in a run-length grammar of each batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.arrays import pieces, utf8, with_columns, words
from tabscope.llm.frames import batched, with_names
from tabscope.llm.recompression import Grammar

# Fewest words of a run of the registered query, and grid places that are looked at together.
LEAST = 12
PLACES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)])
    return found.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _grid(row: np.ndarray, base: np.ndarray, sizes: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places i and distances q with equal words at i and i + q, on a grid that meets every run.

    A run of length at least max(least, 2 q) has max(q, least - q) neighbouring places i in a row with words equal to
    those at i + q, so one of them lies on the grid of that step. As these are at least half of ``least``, so many
    words on one side of the place are equal as well, which is checked here to keep chance matches out.
    """
    around = max((least + 1) // 2, 1) // 2
    long = np.flatnonzero(sizes >= max(least, 2))
    most = sizes[long] // 2
    text = np.repeat(long, most)
    q = np.arange(len(text)) - np.repeat(np.cumsum(most) - most, most) + 1
    grid = np.maximum(q, least - q)
    count = (sizes[text] - 1 - q) // grid + 1
    total = np.cumsum(count)
    at = 0
    while at < len(text):
        to = max(at + 1, int(np.searchsorted(total, total[at] - count[at] + PLACES, "right")))
        part = slice(at, to)
        step = np.arange(count[part].sum()) - np.repeat(total[part] - count[part] - (total[at] - count[at]), count[part])
        i = np.repeat(base[text[part]], count[part]) + step * np.repeat(grid[part], count[part])
        j = i + np.repeat(q[part], count[part])
        same = np.flatnonzero(row[i] == row[j])
        i, j = i[same], j[same]
        # Separators stand at both ends of a text and equal nothing, so a neighbour beyond them ends the search.
        after, before = (np.ones(len(i), bool) for _ in range(2))
        for k in range(1, around + 1):
            after[after] = row[i[after] + k] == row[j[after] + k]
            before[before] = row[i[before] - k] == row[j[before] - k]
        kept = after | before
        yield i[kept], j[kept] - i[kept]
        at = to


def _smallest(start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each stretch once: those found from several places, or with multiples of their period as well."""
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    lead = np.ones(len(start), bool)
    lead[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    return start[lead], length[lead], period[lead]


def find_runs(symbols: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, length and smallest period of every run of at least max(least, 2 periods) symbols.

    ``symbols`` are those of all texts behind each other, ``sizes`` how many each has. A run extends as far as its
    period holds. Ordered by text, start, period.
    """
    n = len(sizes)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(n), sizes)
    row = np.empty(len(symbols) + n + 1, np.int64)
    breaks = np.append(0, ends + np.arange(1, n + 1))
    row[breaks] = np.arange(n + 1)
    row[np.arange(len(symbols)) + owner + 1] = symbols + n + 1
    base = ends - sizes + np.arange(n) + 1
    grammar = Grammar(row, n + 1)
    found = [(np.zeros(0, np.int64),) * 3]
    for i, q in _grid(row, base, sizes, least):
        ahead, behind = grammar.extensions(i, i + q), grammar.extensions(i, i + q, back=True)
        length = ahead + behind + q
        ok = length >= np.maximum(least, 2 * q)
        found.append(_smallest((i - behind)[ok], length[ok], q[ok]))
    start, length, period = _smallest(*(np.concatenate(x) for x in zip(*found, strict=True)))
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    text = np.searchsorted(breaks, start, "right") - 1
    return text, start - base[text], length, period


def collapse_runs(docs: DataFrame, text_col: str = "text", least: int = LEAST, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``runs``, an array of (start, length, period) by start, then period, and ``collapsed``.

    Words are stretches without U+0020 and U+0009 to U+000D, numbered from 0. A run is a stretch of words with smallest
    period q and at least max(least, 2 q) words that cannot be extended with that period. ``collapsed`` holds the words
    that no run contains behind its first period, joined by single spaces. Null, empty and blank texts have no runs and an
    empty ``collapsed``. Rows are independent: repeated rows and ids give equal results. Columns of ``docs`` with these
    two names are replaced. A text is handled as a whole; its memory is a fixed multiple of its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text_col):
            data, offsets = utf8(part.column(text_col))
            starts, ends, owner = words(data, offsets)
            sizes = np.bincount(owner, minlength=part.num_rows).astype(np.int64)
            text, start, length, period = find_runs(numbered(data, starts, ends), sizes, least)
            at = (np.cumsum(sizes) - sizes)[text] + start
            edge = np.zeros(len(starts) + 1, np.int64)
            np.add.at(edge, at + period, 1)
            np.add.at(edge, at + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            values = pa.StructArray.from_arrays([pa.array(start), pa.array(length), pa.array(period)], ["start", "length", "period"])
            bounds = np.searchsorted(text, np.arange(part.num_rows + 1))
            extra = {
                "runs": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values),
                "collapsed": _joined(data, offsets, starts[kept], ends[kept], owner[kept]),
            }
            yield with_columns(part, extra, () if keep_text else (text_col,))

    kept = [f for f in docs.schema if keep_text or f.name != text_col]
    extra = "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return batched(docs).mapInArrow(run, with_names(kept, extra))


def _joined(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray) -> pa.Array:
    """The given words of each text joined by single spaces: each with the blank behind it, but for the last."""
    last = np.append(owner[1:] != owner[:-1], True)[: len(owner)]
    stop = np.where(last, ends, ends + 1)
    edge = np.zeros(len(data) + 2, np.int8)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stop, -1)
    inside = np.cumsum(edge[: len(data)], dtype=np.int8) > 0
    text = data.copy()
    text[ends[~last]] = 0x20
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=before[1:])
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(before[offsets]), pa.py_buffer(text[inside]))


def planted(doc_id: Column, text: Column) -> Column:
    """``text``, made periodic from a place on where crc32 of the id as text is divisible by 10.

    With g the tenth of that crc32 and n words, the words from a = g % n on repeat the first p = 1 + floor((n - a) /
    (3 + g % 8)) of them. A null id or text and a text without words stay as they are.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(found: Column) -> Column:
        n = F.size(found)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        words = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(found, (place(i) + 1).cast("int")))
        return F.when(n > 0, F.array_join(words, " ")).otherwise(text)

    # As an element of an array the words are taken out of the text once, not once a place.
    whole = F.transform(F.array(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), repeated)[0]
    return F.when(h % 10 == 0, whole).otherwise(text)


def run_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """Per row: the id, ``n_runs``, the longest run (ties: smallest start, then period; nulls without one) and the
    digests of all runs and of the collapsed text."""
    rows = collapse_runs(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), least=least, keep_text=False)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return rows.withColumn("best", best).select(
        F.col("doc_id").alias(id_col), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.col3")).alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
