"""Language identification: a linear-chain conditional random field labels every word, forward-backward sums up a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabscope.llm import bpe
from tabscope.llm.arrays import LOWER, U64, Rolling, mix, pieces, utf8, with_columns
from tabscope.llm.frames import BATCH_BYTES, batched, crc_part, with_names

UNKNOWN = "und"
FEATURES = 1 << 16
AFFIXES = (1, 2, 3, 4)
GRAMS = (2, 3)


@dataclass(frozen=True)
class Training:
    """Bounds of the training sample and of the fit."""

    texts_per_language: int = 300
    windows_per_text: int = 4
    words_per_window: int = 48
    epochs: int = 6
    batch: int = 32
    rate: float = 0.3
    decay: float = 1e-5
    seed: int = 11


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every maximal run of letters."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = bpe.class_table()[points]
    letters = np.isin(kinds, (bpe.LETTER, bpe.SINGLE, bpe.R, bpe.V, bpe.L, bpe.E))
    if len(points) != len(data):
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        width[(points >= 0xDC80) & (points <= 0xDCFF)] = 1
        letters = np.repeat(letters, width)
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts, ends = letters.copy(), letters.copy()
    starts[1:] &= ~letters[:-1] | first[1:-1]
    ends[:-1] &= ~letters[1:] | first[1:-1]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(offsets, at, "right") - 1


def features(rolling: Rolling, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of words and the word of each: the word itself, its affixes and its n-grams of bytes."""
    rows = np.arange(len(starts))
    length = ends - starts
    numbers, owner = [], []

    def add(kind: int, low: np.ndarray, high: np.ndarray, of: np.ndarray) -> None:
        hashed = mix(rolling.of(low, high) + U64(kind << 32)) & U64(FEATURES - 1)
        numbers.append(hashed.astype(np.int32))
        owner.append(of)

    add(1, starts, ends, rows)
    for n in AFFIXES:
        long = length >= n
        add(10 + n, starts[long], starts[long] + n, rows[long])
        add(20 + n, ends[long] - n, ends[long], rows[long])
    for n in GRAMS:
        count = np.maximum(length - n + 1, 0)
        of = np.repeat(rows, count)
        place = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        add(30 + n, starts[of] + place, starts[of] + place + n, of)
    return np.concatenate(numbers), np.concatenate(owner)


def _emissions(weights: np.ndarray, numbers: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    out = np.empty((n, weights.shape[1]))
    for k in range(weights.shape[1]):
        out[:, k] = np.bincount(owner, weights=weights[numbers, k], minlength=n)
    return out


def marginals(emissions: np.ndarray, transitions: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label of each word, and the expected label pairs summed over all neighbouring words.

    ``first`` bounds the sequences in ``emissions``. Sequences advance together, longest first; messages are
    normalised at every word, so that no length underflows.
    """
    size = np.diff(first)
    order = np.argsort(-size, kind="stable")
    begin = first[:-1][order]
    at_least = np.searchsorted(-size[order], -np.arange(1, (size.max() if len(size) else 0) + 1), "right")
    local = np.exp(emissions - emissions.max(1, keepdims=True, initial=-np.inf)) + 1e-30
    step = np.exp(transitions - transitions.max())
    forward, backward = np.empty_like(local), np.ones_like(local)
    message = None
    for t, n in enumerate(at_least):
        at = begin[:n] + t
        message = local[at] if t == 0 else (message[:n] @ step) * local[at]
        message /= message.sum(1, keepdims=True)
        forward[at] = message
    pairs = np.zeros_like(step)
    for t in range(len(at_least) - 1, 0, -1):
        at = begin[: at_least[t]] + t
        below = local[at] * backward[at]
        before = below @ step.T
        scale = (forward[at - 1] * before).sum(1, keepdims=True)
        backward[at - 1] = before / scale
        pairs += (forward[at - 1] / scale).T @ below * step
    both = forward * backward
    return both / both.sum(1, keepdims=True), pairs


@dataclass(frozen=True)
class Field:
    """A trained field: feature weights, transition weights and the languages it knows."""

    languages: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray

    def label(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best language (-1: none) and its mean probability over the words of each text."""
        n = len(offsets) - 1
        starts, ends, owner = letter_words(data, offsets)
        if not len(starts) or not self.languages:
            return np.full(n, -1), np.zeros(n)
        rolling = Rolling(LOWER[data])
        _, example, which = np.unique(rolling.of(starts, ends), return_index=True, return_inverse=True)
        numbers, of = features(rolling, starts[example], ends[example])
        emissions = _emissions(self.weights, numbers, of, len(example))[which]
        bounds = np.searchsorted(owner, np.arange(n + 1))
        found, _ = marginals(emissions, self.transitions, bounds)
        sums = np.zeros((len(found) + 1, len(self.languages)))
        np.cumsum(found, axis=0, out=sums[1:])
        share = (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(np.diff(bounds), 1)[:, None]
        best = share.argmax(1)
        score = np.clip(share[np.arange(n), best], 0, 1)
        return np.where(np.diff(bounds) > 0, best, -1), np.where(np.diff(bounds) > 0, score, 0.0)


def fit(windows: list[tuple[str, str]], training: Training = Training()) -> Field:
    """Fit on (language, text) windows, each shorter than a window of ``training``.

    Sequences switch languages: two or three stretches of different windows are joined, so that transitions are
    learned from changes as well as from runs. Adaptive gradient steps on the log likelihood, whose gradient is
    observed minus expected features and label pairs, the latter from forward-backward.
    """
    windows = sorted(windows)
    languages = tuple(sorted({lang for lang, _ in windows}))
    size = len(languages)
    weights, transitions = np.zeros((FEATURES, size)), np.zeros((size, size))
    if size < 2:
        return Field(languages, weights, transitions)
    random = np.random.default_rng(training.seed)
    data, offsets = utf8(pa.array([text for _, text in windows], pa.large_string()))
    starts, ends, owner = letter_words(data, offsets)
    label = np.array([languages.index(lang) for lang, _ in windows])[owner]
    numbers, of = features(Rolling(LOWER[data]), starts, ends)
    by_word = np.argsort(of, kind="stable")
    numbers, feature_bounds = numbers[by_word], np.searchsorted(of[by_word], np.arange(len(starts) + 1))
    words_of = np.searchsorted(owner, np.arange(len(windows) + 1))
    seen, seen_t = np.full_like(weights, 1e-8), np.full_like(transitions, 1e-8)
    usable = np.flatnonzero(np.diff(words_of) > 0)
    for _ in range(training.epochs):
        parts = random.permutation(usable)
        for at in range(0, len(parts), training.batch):
            sequences: list[np.ndarray] = []
            for w in parts[at : at + training.batch]:
                run = [np.arange(words_of[w], words_of[w + 1])]
                for other in random.choice(usable, random.integers(0, 3)):
                    low = random.integers(words_of[other], words_of[other + 1])
                    run.append(np.arange(low, words_of[other + 1]))
                sequences.append(np.concatenate([r[: random.integers(1, len(r) + 1)] if len(run) > 1 else r for r in run]))
            words = np.concatenate(sequences)
            first = np.concatenate([[0], np.cumsum([len(s) for s in sequences])])
            count = feature_bounds[words + 1] - feature_bounds[words]
            ends_ = np.cumsum(count)
            place = np.repeat(feature_bounds[words] - ends_ + count, count) + np.arange(ends_[-1])
            used, row = numbers[place], np.repeat(np.arange(len(words)), count)
            expected, pairs = marginals(_emissions(weights, used, row, len(words)), transitions, first)
            gold = label[words]
            gap = -expected
            gap[np.arange(len(words)), gold] += 1
            inner = np.ones(len(words) - 1, bool)
            inner[first[1:-1] - 1] = False
            observed = np.zeros_like(transitions)
            np.add.at(observed, (gold[:-1][inner], gold[1:][inner]), 1)
            touched, position = np.unique(used, return_inverse=True)
            step = np.empty((len(touched), size))
            for k in range(size):
                step[:, k] = np.bincount(position, weights=gap[row, k])
            step = step / len(sequences) - training.decay * weights[touched]
            seen[touched] += step**2
            weights[touched] += training.rate * step / np.sqrt(seen[touched])
            step_t = (observed - pairs) / len(sequences)
            seen_t += step_t**2
            transitions += training.rate * step_t / np.sqrt(seen_t)
    return Field(languages, weights, transitions)


def training_windows(rows: DataFrame, training: Training = Training()) -> list[tuple[str, str]]:
    """Windows of a bounded sample of (``doc_id``, ``text``, ``lang``): some texts per language, by a hash of the id.

    At most ``texts_per_language`` * ``windows_per_text`` windows per language reach the driver.
    """
    keys = rows.select("doc_id", "lang").withColumn("at", F.xxhash64("doc_id"))
    place = "row_number() OVER (PARTITION BY lang ORDER BY at, doc_id) AS place"
    chosen = keys.selectExpr("*", place).where(F.col("place") <= training.texts_per_language).select("doc_id", "lang")
    texts = rows.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi").select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(batches, "text"):
            data, offsets = utf8(part.column("text"))
            starts, ends, owner = letter_words(data, offsets)
            bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
            langs, out = part.column("lang").to_pylist(), []
            for i, lang in enumerate(langs):
                n = bounds[i + 1] - bounds[i]
                span = training.words_per_window
                for low in np.unique(np.linspace(0, max(n - span, 0), training.windows_per_text).astype(int)) if n else ():
                    a, b = bounds[i] + low, min(bounds[i] + low + span, bounds[i + 1]) - 1
                    out.append((lang, data[starts[a] : ends[b]].tobytes().decode("utf-8", "replace")))
            yield pa.RecordBatch.from_pydict({"lang": pa.array([x for x, _ in out], pa.string()), "text": pa.array([x for _, x in out], pa.string())})

    found = batched(texts).mapInArrow(run, "lang string, text string").collect()
    return [(r["lang"], r["text"]) for r in found]


def identify(docs: DataFrame, field: Field, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` from the whole text; ``und`` and 0 for null and letterless texts."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*shared.value.languages, UNKNOWN], object)
        for part in pieces(batches, text_col, BATCH_BYTES):
            best, score = shared.value.label(*utf8(part.column(text_col)))
            extra = {"lang_pred": pa.array(names[best], pa.string()), "score": pa.array(score)}
            yield with_columns(part, extra, () if keep_text else (text_col,))

    kept = [f for f in docs.schema if keep_text or f.name != text_col]
    return batched(docs).mapInArrow(run, with_names(kept, "lang_pred string, score double"))


def predict_languages(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` for every row of ``docs``.

    Learns from text and language of rows outside the held-out third (crc32 of the id as text, modulo 3, is 1);
    rows without a language are not learned from. Without any language everything is ``und``. Repeated ids are
    separate rows; a null id counts as an empty text where parts are made.
    """
    held_out = crc_part(F.col("doc_id")) == 1
    known = docs.select("doc_id", "text", "lang").where(~held_out & F.col("lang").isNotNull() & F.col("text").isNotNull())
    field = fit(training_windows(known, training), training)
    return identify(docs.select("doc_id", held_out.alias("held_out"), "text"), field, keep_text=False)
