"""Byte-level BPE: pre-tokens found by scanning character classes, merged through a cache, decoded by offsets."""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tabscope.llm.arrays import Rolling, pieces, tidy, utf8, with_columns
from tabscope.llm.frames import batched, with_names

# The code points with the Unicode property White_Space.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Letters and numbers that Unicode 16.0 added; Python's own tables may end with an earlier version.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA),
]

# Classes of code points. The last five are letters that can end the contractions 's 't 'm 'd 're 've 'll.
OTHER, LETTER, NUMBER, SPACE, WHITE, QUOTE, SINGLE, R, V, L, E = range(11)
CLASSES = 11
# States after a character: nothing read, inside a run of one kind, a quote that starts a pre-token,
# that quote and r, v or l, and a contraction that has just ended.
START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ON_SPACE, ON_WHITE, ON_QUOTE, ON_R, ON_V, ON_L, ENDED = range(11)
STATES = 11

CACHE_SLOTS = 100_000
_BLOCK = 256


@lru_cache(1)
def class_table() -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    table[:] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)]
    for ranges, kind in ((NEW_LETTERS, LETTER), (NEW_NUMBERS, NUMBER)):
        for low, high in ranges:
            table[low : high + 1] = kind
    table[WHITE_SPACE] = WHITE
    for characters, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", SINGLE), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in characters]] = kind
    return table


@lru_cache(1)
def transitions() -> np.ndarray:
    """Next state by class and state; classes from ``CLASSES`` on stand for the first character of a text."""
    plain = {OTHER: IN_OTHERS, NUMBER: IN_NUMBERS, SPACE: ON_SPACE, WHITE: ON_WHITE}
    follows = {(ON_QUOTE, SINGLE): ENDED, (ON_QUOTE, R): ON_R, (ON_QUOTE, V): ON_V, (ON_QUOTE, L): ON_L,
               (ON_R, E): ENDED, (ON_V, E): ENDED, (ON_L, L): ENDED}
    table = np.zeros((2 * CLASSES, STATES), np.uint8)
    for kind in range(CLASSES):
        for state in range(STATES):
            to = follows.get((state, kind), plain.get(kind, IN_LETTERS))
            if kind == QUOTE:
                to = IN_OTHERS if state in (IN_OTHERS, ON_SPACE, ON_QUOTE) else ON_QUOTE
            table[kind, state] = to
        table[CLASSES + kind] = table[kind, START]
    return table


@lru_cache(1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that compositions of transitions give: number by class, product by (first, then), values by state.

    Number 0 is the identity. There are a few dozen, so that a composition is one look-up of a small number.
    """
    generators = [tuple(row) for row in transitions().tolist()]
    functions = [tuple(range(STATES))]
    numbers = {functions[0]: 0}
    for first in functions:  # grows while it is walked
        for then in generators:
            composed = tuple(then[state] for state in first)
            if composed not in numbers:
                numbers[composed] = len(functions)
                functions.append(composed)
    product = [[numbers[tuple(then[state] for state in first)] for then in functions] for first in functions]
    kind = np.uint8 if len(functions) <= 256 else np.uint16
    return np.array([numbers[g] for g in generators], kind), np.array(product, kind), np.array(functions, np.uint8)


def scan(kinds: np.ndarray) -> np.ndarray:
    """The state after every character.

    A class is a function from states to states, and composing functions is associative: prefixes are composed in
    all blocks side by side, the functions of whole blocks in a doubling scan; every prefix is then applied to the
    state in which its block starts.
    """
    by_class, product, values = monoid()
    n, size = len(kinds), len(values)
    rows = max(1, -(-n // _BLOCK))
    padded = np.zeros(rows * _BLOCK, by_class.dtype)
    padded[:n] = by_class[kinds]
    steps = np.ascontiguousarray(padded.reshape(rows, _BLOCK).T)
    flat = product.ravel()
    prefix = np.empty((_BLOCK, rows), flat.dtype)
    prefix[0] = steps[0]
    for k in range(1, _BLOCK):
        flat.take(prefix[k - 1].astype(np.intp) * size + steps[k], out=prefix[k])
    whole = prefix[-1].astype(np.intp)
    distance = 1
    while distance < rows:
        whole[distance:] = flat[whole[:-distance] * size + whole[distance:]]
        distance *= 2
    entry = np.full(rows, START, np.intp)
    entry[1:] = values[whole[:-1], START]
    states = values.ravel().take(prefix.astype(np.intp) * STATES + entry[None, :])
    return np.ascontiguousarray(states.T).ravel()[:n]


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the pre-tokens of all texts start, and the text number of each."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) == len(data):
        at = np.arange(len(data) + 1)
    else:
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        width[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(width, out=at[1:])
    kinds = class_table()[points]
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[np.searchsorted(at, offsets)] = True
    kinds[first[:-1]] += CLASSES
    states = scan(kinds)
    before = np.empty(n, np.uint8)
    before[1:] = states[:-1]
    before[first[:-1]] = START
    after = np.full(n, START, np.uint8)
    after[:-1] = states[1:]
    after[first[1:]] = START
    # Start of a pre-token by (state before, state now).
    begins = np.ones((STATES, STATES), bool)
    begins[[IN_LETTERS, ON_SPACE, ON_R, ON_V, ON_L], IN_LETTERS] = False
    begins[[IN_NUMBERS, ON_SPACE], IN_NUMBERS] = False
    begins[[IN_OTHERS, ON_QUOTE, ON_SPACE], IN_OTHERS] = False
    begins[:, ENDED] = False
    begin = begins.ravel().take(before.astype(np.intp) * STATES + states)
    pending = np.flatnonzero((states >= ON_R) & (states <= ON_L))
    begin[pending] = after[pending] != ENDED
    white = (states == ON_SPACE) | (states == ON_WHITE)
    inner = np.flatnonzero(white & ((before == ON_SPACE) | (before == ON_WHITE)))
    begin[inner] = (after[inner] != START) & (after[inner] != ON_SPACE) & (after[inner] != ON_WHITE)
    starts = at[:-1][begin]
    return starts, np.searchsorted(offsets, starts, "right") - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary of a rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Join the neighbours of lowest rank (the first of equals) until no pair is in the vocabulary.

    A heap of pairs over a linked list: n log n also for a piece of a million bytes.
    """
    n = len(piece)
    if piece in ranks:
        return [ranks[piece]]
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    pairs = [(ranks[piece[i : i + 2]], i, i + 2) for i in range(n - 1) if piece[i : i + 2] in ranks]
    heapq.heapify(pairs)
    while pairs:
        _, i, stop = heapq.heappop(pairs)
        j = end[i]
        if j == 0 or j >= n or end[j] != stop:
            continue  # a side of this pair has been merged since
        end[i], end[j] = stop, 0
        if stop < n:
            before[stop] = i
            if (joined := piece[i : end[stop]]) in ranks:
                heapq.heappush(pairs, (ranks[joined], i, end[stop]))
        if (left := before[i]) >= 0 and (joined := piece[left:stop]) in ranks:
            heapq.heappush(pairs, (ranks[joined], left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Pairs:
    """Rank of the token that two neighbouring tokens form, in arrays sorted by the pair."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]) -> None:
        found = {
            (ranks[token[:k]] << 32) | ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.keys = np.array(sorted(found), np.int64)
        self.ranks = np.array([found[k] for k in self.keys.tolist()] + [self.NONE], np.int32)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair; ``NONE`` where a side is missing (negative) or the pair is no token."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.keys, wanted)
        hit = (left >= 0) & (right >= 0) & (at < len(self.keys))
        hit &= self.keys[np.minimum(at, len(self.keys) - 1)] == wanted
        return np.where(hit, self.ranks[at], self.NONE)

    def merge(self, pieces: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each piece of at most ``width`` bytes (a row padded with -1), and their number.

        All pieces take their next merge, the first of lowest rank, at the same time.
        """
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        sizes = np.array([len(p) for p in pieces])
        column = np.arange(width)
        ids = np.where(column < sizes[:, None], self.single[raw], -1).astype(np.int32)
        out = ids.copy()
        rows = np.arange(len(pieces))
        ranks = np.full((len(pieces), width), self.NONE, np.int32)
        ranks[:, :-1] = self.of(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(1)
            here = np.arange(len(rows))
            best = ranks[here, at]
            going = best != self.NONE
            if not going.all():
                out[rows[~going]] = ids[~going]
                rows, ids, ranks, at, best = rows[going], ids[going], ranks[going], at[going], best[going]
                here = np.arange(len(rows))
                if not len(rows):
                    break
            for table, blank in ((ids, -1), (ranks, self.NONE)):
                shifted = np.full_like(table, blank)
                shifted[:, :-1] = table[:, 1:]
                np.copyto(table, shifted, where=column > at[:, None])
            ids[here, at] = best
            after = ids[here, np.minimum(at + 1, width - 1)]
            ranks[here, at] = self.of(best, np.where(at + 1 < width, after, -1))
            inner = at > 0
            ranks[here[inner], at[inner] - 1] = self.of(ids[here[inner], at[inner] - 1], best[inner])
        return out, (out >= 0).sum(1)


class Cache(dict):
    """Number of each pre-token in a store of merged ids."""

    WIDTHS = (8, 12, 16, 24, 32)

    def __init__(self, ranks: dict[bytes, int], pairs: Pairs) -> None:
        super().__init__()
        self.ranks, self.pairs = ranks, pairs
        self.ids = array("i")
        self.bounds = array("q", [0])

    def _add(self, pieces: list[bytes], flat: np.ndarray, counts: np.ndarray) -> None:
        base = len(self.bounds) - 1
        self.update(zip(pieces, range(base, base + len(pieces)), strict=True))
        self.bounds.frombytes((np.cumsum(counts) + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(flat.astype(np.int32).tobytes())

    def learn(self, pieces: list[bytes]) -> None:
        """Merge the pieces that are new: short ones in rows of equal width, others one by one."""
        new = [p for p in set(pieces) if p not in self]
        whole = [p for p in new if p in self.ranks]
        self._add(whole, np.array([self.ranks[p] for p in whole], np.int32), np.ones(len(whole), np.int64))
        rest = [p for p in new if p not in self.ranks]
        low = 0
        for width in self.WIDTHS:
            part = [p for p in rest if low < len(p) <= width]
            low = width
            if part:
                rows, counts = self.pairs.merge(part, width)
                self._add(part, rows[rows >= 0], counts)
        for piece in rest:
            if len(piece) > low:
                merged = np.array(merge(piece, self.ranks), np.int32)
                self._add([piece], merged, np.array([len(merged)]))


def _ragged(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions begin, begin + 1, ... of every run, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(begins - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)


class Codec:
    """Encoder and decoder of one vocabulary, with the cache of one Python worker."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.slots = Cache(ranks, Pairs(ranks))
        tokens: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.cumsum(self.lengths) - self.lengths

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, their end offsets within the text, and the bounds of each text in both."""
        if len(self.slots) > CACHE_SLOTS:
            self.slots = Cache(self.slots.ranks, self.slots.pairs)
        starts, owner = pre_tokens(data, offsets)
        ends = np.append(starts[1:], len(data))
        raw = data.tobytes()
        # Equal pre-tokens of the batch meet by a 64-bit hash of bytes and length; the cache holds the bytes themselves.
        hashes = Rolling(data).of(starts, ends)
        _, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        spans = zip(starts[example].tolist(), ends[example].tolist(), strict=True)
        slices = [raw[a:b] for a, b in spans]
        self.slots.learn(slices)
        slot = np.fromiter(map(self.slots.__getitem__, slices), np.int64, len(slices))[which]
        bounds = np.array(self.slots.bounds, np.int64)
        lengths = bounds[slot + 1] - bounds[slot]
        ids = np.array(self.slots.ids, np.int32)[_ragged(bounds[slot], lengths)]
        by_text = np.zeros(len(offsets), np.int64)
        np.cumsum(np.bincount(owner, weights=lengths, minlength=len(offsets) - 1).astype(np.int64), out=by_text[1:])
        stops = np.cumsum(self.lengths[ids])
        stops -= np.repeat(offsets[:-1], np.diff(by_text))
        return ids, stops, by_text

    def decode(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[_ragged(self.begins[ids], self.lengths[ids])]


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec per vocabulary and worker, so that the cache outlives the task."""
    if shared.id not in _CODECS:
        _CODECS.clear()
        _CODECS[shared.id] = Codec(shared.value)
    return _CODECS[shared.id]


class _Shared:
    """A broadcast vocabulary (as long as its file, some megabytes) with a number that outlives pickling."""

    def __init__(self, spark, path: str) -> None:
        self._broadcast = spark.sparkContext.broadcast(load_ranks(path))
        self.id = self._broadcast._jbroadcast.id()

    @property
    def value(self) -> dict[bytes, int]:
        return self._broadcast.value


def encode(
    docs: DataFrame, ranks_path: str, text_col: str = "text", ids: str = "ids", ends: str = "ends", keep_text: bool = True
) -> DataFrame:
    """``docs`` with the token ids of the whole text and each token's end offset in its UTF-8 bytes.

    Null and empty texts have no tokens. Columns of ``docs`` named like the new ones are replaced.
    ``keep_text=False`` leaves the text out. Rows are independent: repeated ids and null ids do not matter.
    """
    shared = _Shared(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for part in pieces(batches, text_col):
            tokens, stops, bounds = codec.encode(*utf8(part.column(text_col)))
            at = pa.array(bounds, pa.int32())
            yield with_columns(
                part,
                {
                    ids: pa.ListArray.from_arrays(at, pa.array(tokens)),
                    ends: pa.ListArray.from_arrays(at, pa.array(stops.astype(np.int32))),
                },
                () if keep_text else (text_col,),
            )

    kept = [f for f in docs.schema if keep_text or f.name != text_col]
    return batched(docs).mapInArrow(tidy(run), with_names(kept, f"{ids} array<int>, {ends} array<int>"))


def decode(
    tokens: DataFrame, ranks_path: str, ids: str = "ids", ends: str = "ends", decoded: str = "decoded"
) -> DataFrame:
    """``tokens`` with the bytes of their ids; the retained offsets place every token and are checked by it."""
    shared = _Shared(tokens.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            column, stops = batch.column(ids), batch.column(ends)
            ids_here = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = codec.decode(ids_here)
            counts = np.diff(column.offsets.to_numpy()).astype(np.int64)
            last = np.cumsum(counts)
            stop = stops.flatten().to_numpy(zero_copy_only=False)
            sizes = np.zeros(len(counts), np.int64)
            sizes[counts > 0] = stop[last[counts > 0] - 1]
            offsets = np.concatenate([[0], np.cumsum(sizes)])
            if offsets[-1] != len(flat):
                raise ValueError("token offsets do not belong to these ids")
            buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat))]
            texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), buffers)
            yield with_columns(batch, {decoded: texts})

    return batched(tokens).mapInArrow(tidy(run), with_names(tokens.schema, f"{decoded} binary"))


def digests(docs: DataFrame, ranks_path: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``n_tokens`` and SHA-256 of the ids and of the bytes decoded from them.

    Encodes and decodes in one pass, so that the ids of long texts never leave the worker. The ids are hashed as
    little-endian unsigned 32-bit integers.
    """
    shared = _Shared(docs.sparkSession, ranks_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for part in pieces(batches, text_col, 1 << 21):
            ids, stops, bounds = codec.encode(*utf8(part.column(text_col)))
            packed, decoded = ids.astype("<u4").tobytes(), codec.decode(ids).tobytes()
            sizes = np.where(np.diff(bounds) > 0, stops[np.maximum(bounds[1:] - 1, 0)] if len(stops) else 0, 0)
            ends = np.cumsum(sizes).tolist()
            of_ids = [hashlib.sha256(packed[4 * a : 4 * b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            of_bytes = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip([0, *ends], ends, strict=False)]
            extra = {
                "n_tokens": pa.array(np.diff(bounds)), "ids_sha256": pa.array(of_ids), "decoded_sha256": pa.array(of_bytes)
            }
            yield with_columns(part, extra, (text_col,))

    kept = [f for f in docs.schema if f.name != text_col]
    return batched(docs).mapInArrow(tidy(run), with_names(kept, "n_tokens long, ids_sha256 string, decoded_sha256 string"))
