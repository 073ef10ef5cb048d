"""Secrets in texts: keyword automaton first, anchored expressions at its hits, checksums where a token has one."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.arrays import pieces, utf8, with_columns
from tabscope.llm.frames import batched, with_names

# Kinds in the order in which equal starts are listed. The first three are the base, the others are
# tokens whose last six characters are a checksum of those before.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]

# Keywords (found in either case) and the expression that has to match where one starts,
# with the group whose length counts and its least length.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
PATTERNS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "github": (r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])", 1, 36),
    "npm": (r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])", 1, 36),
}
HEX_LEAST = 24
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
CHECKSUM = 6

_HEX = np.zeros(256, bool)
_HEX[[*b"0123456789abcdef"]] = True


@lru_cache(1)
def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


@lru_cache(1)
def _compiled() -> dict[str, tuple[re.Pattern, int, int]]:
    return {kind: (re.compile(p), group, least) for kind, (p, group, least) in PATTERNS.items()}


def checksum_holds(body: str) -> bool:
    """Whether the last six characters are the CRC-32 of the others in base 62, padded with zeros."""
    value = zlib.crc32(body[:-CHECKSUM].encode())
    digits = ""
    for _ in range(CHECKSUM):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits == body[-CHECKSUM:]


def find(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, kind, start and end (bytes in ``data``) of all spans, by text, start and kind.

    Every byte becomes one character, so places are bytes; all expressions are ASCII. A match can only start at a
    keyword, so trying the hits in order, skipping those inside the last match of their kind, gives the leftmost
    non-overlapping matches. Runs of hex digits have no keyword: they are read off a mask of the bytes.
    """
    raw = data.tobytes()
    plain, lower = raw.decode("latin-1"), raw.lower().decode("latin-1")
    hits: list[tuple[int, str]] = sorted({(end - size + 1, kind) for end, (kind, size) in _automaton().iter(lower)})
    limits = offsets[np.searchsorted(offsets, [at for at, _ in hits], "right")].tolist() if hits else []
    patterns = _compiled()
    last = dict.fromkeys(KINDS, 0)
    spans: list[tuple[int, int, int]] = []
    for (at, kind), limit in zip(hits, limits, strict=True):
        if at < last[kind]:
            continue
        expression, group, least = patterns[kind]
        if match := expression.match(plain, at, limit):
            last[kind] = match.end()
            if match.end(group) - match.start(group) >= least and (kind in BASE or checksum_holds(match[group])):
                spans.append((at, KINDS.index(kind), match.end()))
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _HEX[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    starts[cut] = inside[1:-1][cut]
    ends[cut - 1] = inside[1:-1][cut - 1]
    low, high = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    long = high - low >= HEX_LEAST
    found = np.array(spans, np.int64).reshape(-1, 3)
    start = np.concatenate([found[:, 0], low[long]])
    kind_no = np.concatenate([found[:, 1], np.full(long.sum(), KINDS.index("hex"))])
    end = np.concatenate([found[:, 2], high[long]])
    order = np.lexsort((kind_no, start))
    return np.searchsorted(offsets, start[order], "right") - 1, kind_no[order], start[order], end[order]


def _points(data: np.ndarray) -> np.ndarray:
    """How many code points start before each byte."""
    counts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=counts[1:])
    return counts


def scan_secrets(docs: DataFrame, text_col: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` with an array of (kind, start, end) in ``out``: places in code points, end exclusive.

    Spans are ordered by start, then kind. Null, empty and clean texts have an empty array. A column of ``docs``
    named like ``out`` is replaced; rows are independent, so repeated or null ids do not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text_col):
            data, offsets = utf8(part.column(text_col))
            owner, kind, start, end = find(data, offsets)
            before = _points(data)
            base = before[offsets[owner]]
            values = pa.StructArray.from_arrays(
                [
                    pa.array(np.array(KINDS, object)[kind], pa.string()),
                    pa.array(before[start] - base),
                    pa.array(before[end] - base),
                ],
                ["kind", "start", "end"],
            )
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            yield with_columns(part, {out: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), values)})

    schema = with_names(docs.schema, f"{out} array<struct<kind:string,start:long,end:long>>")
    return batched(docs).mapInArrow(run, schema)


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """The spans of the given kinds as kind:start:end, joined by commas."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every maximal stretch covered by spans replaced by ``mark``; null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, text_col):
            column = part.column(text_col)
            data, offsets = utf8(column)
            owner, _, start, end = find(data, offsets)
            texts: dict[int, bytes] = {}
            for row in np.unique(owner):
                spans = owner == row
                at, out = int(offsets[row]), b""
                reach = at
                for low, high in zip(start[spans].tolist(), end[spans].tolist(), strict=True):
                    if low >= reach:
                        out += data[reach:low].tobytes() + mark.encode()
                    reach = max(reach, high)
                texts[int(row)] = out + data[reach : offsets[row + 1]].tobytes()
            if texts:
                values = [texts.get(i, None) for i in range(len(column))]
                clean = pa.array([v is None for v in values])
                column = pa.compute.if_else(clean, column.cast(pa.large_string()), pa.array(values, pa.large_binary()).cast(pa.large_string()))
            yield with_columns(part, {text_col: column.cast(pa.large_string())}).select(part.schema.names)

    return batched(docs).mapInArrow(run, docs.schema)
