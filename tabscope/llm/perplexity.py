"""Quality rules: counts of a text and the perplexity of a modified Kneser-Ney model, judged by language."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.aggregates import small
from tabscope.llm import bpe, wordgrams
from tabscope.llm.arrays import U64, Rolling, give_back, joined, mix, odd_weights, per_text, pieces, slices, utf8, with_columns, words
from tabscope.llm.frames import batched, stored, with_names

# Characters are folded into this many symbols, so that there are at most SYMBOLS ** ORDER n-grams (5.3 million),
# whatever the corpus: the bound of each model that is sent to the executors.
SYMBOLS = 48
ORDER = 4
GRAMS = SYMBOLS**ORDER
# A text is in the fold of its least hash of so many bytes, which near copies share; see ``folds``.
FOLD_BYTES = 32
# The characters counted as symbols.
MARKS = "#*$%&|<>"
WINDOW = 8

_MARK = np.zeros(256, bool)
_MARK[[*MARKS.encode()]] = True


@lru_cache(1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point: white space, a-z, numbers, other letters by remainder, groups of punctuation."""
    kinds = bpe.class_table()
    table = np.full(0x110000, 47, np.uint8)
    letters = np.isin(kinds, (bpe.LETTER, bpe.SINGLE, bpe.R, bpe.V, bpe.L, bpe.E))
    table[letters] = (28 + np.arange(0x110000) % 12)[letters]
    table[kinds == bpe.NUMBER] = 27
    table[(kinds == bpe.SPACE) | (kinds == bpe.WHITE)] = 0
    for k in range(26):
        table[[ord("a") + k, ord("A") + k]] = k + 1
    for symbol, characters in ((40, "."), (41, ","), (42, "'\"«»“”‘’"), (43, "-–—"), (44, "!?;:¿¡"), (45, MARKS), (46, "()[]{}/\\_+=@~`^")):
        table[[ord(c) for c in characters]] = symbol
    return table


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of the n-gram that ends at each code point (a text is preceded by blanks) and the bounds of each text."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "surrogateescape").encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = offsets
    if len(points) != len(data):
        starts = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=starts[1:])
        bounds = np.minimum(starts[offsets], len(points))
        bounds[-1] = len(points)
    symbols = symbol_table()[points].astype(np.int32)
    codes = symbols.copy()
    place = np.arange(len(points), dtype=np.int64) - np.repeat(bounds[:-1], np.diff(bounds))
    factor = 1
    for back in range(1, ORDER):
        factor *= SYMBOLS
        earlier = np.zeros_like(symbols)
        earlier[back:] = symbols[:-back]
        codes += np.where(place >= back, earlier, 0) * factor
    return codes, bounds


def folds(data: np.ndarray, offsets: np.ndarray, rolling: Rolling | None = None) -> np.ndarray:
    """0 or 1 for each text, by the least hash of its windows of ``FOLD_BYTES`` bytes (of all of a shorter text).

    Texts share it with a probability of (1 + likeness of their windows) / 2 at least, so near copies are nearly always in one
    fold and do not vouch for each other in the model of the other one.
    """
    rolling = Rolling(data) if rolling is None else rolling
    least = rolling.of(offsets[:-1], offsets[1:])
    long = np.flatnonzero(np.diff(offsets) >= FOLD_BYTES)
    if len(long):
        windows = np.append(rolling.windows(FOLD_BYTES), U64(0))
        bounds = np.stack([offsets[long], offsets[long + 1] - FOLD_BYTES + 1], 1).ravel()
        least[long] = np.minimum.reduceat(windows, bounds)[::2]
    return (mix(least) & U64(1)).astype(np.int64)


def gram_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``fold``, ``code``, ``n`` of every n-gram of all whole texts. Each task counts in one array before anything is moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * GRAMS, np.int64)
        for part in pieces(batches, text_col):
            for data, offsets in slices(*utf8(part.column(text_col))):
                codes, bounds = gram_codes(data, offsets)
                np.add.at(total, codes + GRAMS * np.repeat(folds(data, offsets), np.diff(bounds)), 1)
        seen = np.flatnonzero(total)
        for at in range(0, len(seen), 1 << 16):
            some = seen[at : at + (1 << 16)]
            columns = {"fold": (some // GRAMS).astype(np.int32), "code": (some % GRAMS).astype(np.int32), "n": total[some]}
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})
        del total
        give_back()

    counted = batched(docs.select(text_col)).mapInArrow(run, "fold int, code int, n long")
    return counted.groupBy("fold", "code").agg(F.sum("n").alias("n"))


def _discounts(grams: DataFrame) -> list[float]:
    """Discounts of grams counted once, twice and more often, from how many grams are counted 1 to 4 times."""
    counted = [F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in range(1, 5)]
    n1, n2, n3, n4 = grams.agg(*counted).first()
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    raw = [k - (k + 1) * y * (b / a) if a else 0.5 * k for k, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)), 1)]
    return [min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1)]


def _hashed(codes: np.ndarray, level: int) -> np.ndarray:
    return mix(codes.astype(U64) + (U64(level + 1) << U64(40)))


@dataclass(frozen=True)
class Model:
    """Sorted hashes of all n-grams with their log probabilities, and of all contexts with their log back-off."""

    grams: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    backoffs: np.ndarray

    def _at(self, keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return at, keys[at] == wanted

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of the last symbol of each n-gram after the others, backing off to shorter ones."""
        out = np.zeros(len(codes))
        left = np.arange(len(codes))
        rest = codes.astype(np.int64)
        for level in range(ORDER, 0, -1):
            at, hit = self._at(self.grams, _hashed(rest, level))
            out[left[hit]] += self.logs[at[hit]]
            left, rest = left[~hit], rest[~hit]
            at, hit = self._at(self.contexts, _hashed(rest // SYMBOLS, level))
            out[left[hit]] += self.backoffs[at[hit]]
            rest = rest % SYMBOLS ** (level - 1)
        out[left] += -np.log(SYMBOLS)
        return out


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Modified Kneser-Ney model over all whole texts, interpolated, down to the uniform distribution."""
    return _model(gram_counts(docs, text_col).groupBy("code").agg(F.sum("n").alias("n")))


def fold_models(docs: DataFrame, text_col: str = "text") -> list[Model]:
    """For the texts of each fold, the model over all whole texts of the other one."""
    counts = stored(gram_counts(docs, text_col), "grams")
    return [_model(counts.where(F.col("fold") == 1 - m).select("code", "n")) for m in range(2)]


def _model(counts: DataFrame) -> Model:
    """The model of ``code``, ``n``. Continuation counts, discounts and probabilities are made in Spark; what the driver
    collects has at most ``SYMBOLS ** ORDER`` rows by construction."""
    levels = {ORDER: stored(counts, "grams")}
    for level in range(ORDER - 1, 0, -1):
        short = (F.col("code") % SYMBOLS**level).cast("int").alias("code")
        levels[level] = stored(levels[level + 1].groupBy(short).agg(F.count(F.lit(1)).alias("n")), "grams")
    below = None
    parts, tails = [], []
    for level in range(1, ORDER + 1):
        grams = levels[level].withColumn("context", F.floor(F.col("code") / SYMBOLS).cast("int"))
        ones, twos, more = _discounts(levels[level])
        discount = F.when(F.col("n") == 1, ones).when(F.col("n") == 2, twos).otherwise(more)
        grams = grams.withColumn("discount", discount)
        contexts = grams.groupBy("context").agg(F.sum("n").alias("total"), F.sum("discount").alias("spared"))
        contexts = contexts.withColumn("gamma", F.col("spared") / F.col("total"))
        grams = grams.join(contexts, "context")
        own = (F.col("n") - F.col("discount")) / F.col("total")
        if below is None:
            grams = grams.withColumn("p", own + F.col("gamma") / SYMBOLS)
        else:
            lower = below.select(F.col("code").alias("short"), F.col("p").alias("q"))
            grams = grams.withColumn("short", (F.col("code") % SYMBOLS ** (level - 1)).cast("int")).join(lower, "short")
            grams = grams.withColumn("p", own + F.col("gamma") * F.col("q"))
        below = stored(grams.select("code", "p"), "probabilities")
        parts.append((level, below.toPandas()))
        tails.append((level, contexts.select("context", "gamma").toPandas()))

    def arrays(tables, key: str, value: str) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([_hashed(t[key].to_numpy(np.int64), level) for level, t in tables])
        logs = np.concatenate([np.log(t[value].to_numpy(float)) for _, t in tables])
        order = np.argsort(keys)
        return keys[order], logs[order]

    return Model(*arrays(parts, "code", "p"), *arrays(tails, "context", "gamma"))


def repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries of (text, hash): whether another entry is equal, and whether an earlier one is."""
    if not len(hashes):
        return np.zeros(0, bool), np.zeros(0, bool)
    keys = hashes + owner.astype(U64) * U64(odd_weights(1)[0])
    order = np.argsort(keys)
    lead = np.ones(len(order), bool)
    lead[1:] = keys[order][1:] != keys[order][:-1]
    heads = np.flatnonzero(lead)
    sizes = np.diff(np.append(heads, len(order)))
    any_other = np.zeros(len(order), bool)
    any_other[order] = np.repeat(sizes > 1, sizes)
    again = any_other.copy()
    again[np.minimum.reduceat(order, heads)] = False
    return any_other, again


def base_counts(data: np.ndarray, offsets: np.ndarray, rolling: Rolling | None = None) -> dict[str, np.ndarray]:
    """``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` of each text."""
    n = len(offsets) - 1
    starts, ends, owner = words(data, offsets)
    rolling = Rolling(data) if rolling is None else rolling
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    marks = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_MARK[data], out=marks[1:])
    count = lambda values: np.bincount(owner, weights=values, minlength=n).astype(np.int64)

    windows = joined(rolling.of(starts, ends), odd_weights(WINDOW))
    inside = np.flatnonzero(owner[: len(windows)] == owner[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    twice, _ = repeated(owner[inside], windows[inside])
    edge = np.zeros(len(starts) + WINDOW + 1, np.int64)
    np.add.at(edge, inside[twice], 1)
    np.add.at(edge, inside[twice] + WINDOW, -1)
    covered = np.cumsum(edge)[: len(starts)] > 0

    breaks = np.flatnonzero(data == 10)
    lines = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    line_of = np.searchsorted(lines, starts, "right") - 1
    lead = np.ones(len(starts), bool)
    lead[1:] = line_of[1:] != line_of[:-1]
    line_start = lines[line_of[lead]]
    line_owner = owner[lead]
    following = np.append(breaks, len(data))[np.searchsorted(breaks, starts[lead])]
    line_end = np.minimum(following, offsets[line_owner + 1])
    _, again = repeated(line_owner, rolling.of(line_start, line_end))
    return {
        "n_words": per_text(owner, n),
        "word_chars": count(points[ends] - points[starts]),
        "n_symbols": np.diff(marks[offsets]),
        "n_dup_lines": np.bincount(line_owner, weights=again, minlength=n).astype(np.int64),
        "n_repeat_words": count(covered),
    }


MEASURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, log_perplexity double"


def _per_part(texts: pa.Array, of: Callable[[np.ndarray, np.ndarray], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """What ``of`` finds for each text of a column, slice by slice."""
    found = [of(data, offsets) for data, offsets in slices(*utf8(texts))]
    return {k: np.concatenate([x[k] for x in found]) for k in found[0]}


def measure(docs: DataFrame, model: Model | list[Model], text_col: str = "text", keep_text: bool = True, keys: bool = False) -> DataFrame:
    """``docs`` with the base counts and ``log_perplexity`` (null for texts without a character); with ``keys`` also
    ``text_key``, which equal texts share. Of several models each judges the texts of its fold."""
    shared = docs.sparkSession.sparkContext.broadcast(model if isinstance(model, list) else [model])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        table = np.full(len(models) * GRAMS, np.nan)

        def judged(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
            rolling = Rolling(data)
            codes, bounds = gram_codes(data, offsets)
            sizes = np.diff(bounds)
            judge_of = folds(data, offsets, rolling) if len(models) > 1 else np.zeros(len(sizes), np.int64)
            codes = codes + GRAMS * np.repeat(judge_of, sizes)
            logs = table[codes]
            lost = np.flatnonzero(np.isnan(logs))
            unknown = np.unique(codes[lost])
            cuts = np.searchsorted(unknown, GRAMS * np.arange(len(models) + 1))
            for m, one in enumerate(models):
                new = unknown[cuts[m] : cuts[m + 1]]
                table[new] = one.log_probability(new - GRAMS * m)
            logs[lost] = table[codes[lost]]
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            mean = np.divide(sums[bounds[1:]] - sums[bounds[:-1]], np.maximum(sizes, 1))
            extra = base_counts(data, offsets, rolling) | {"log_perplexity": np.where(sizes == 0, np.nan, -mean)}
            return extra | ({"text_key": wordgrams.text_keys(data, offsets, rolling)} if keys else {})

        for part in pieces(batches, text_col):
            extra = _per_part(part.column(text_col), judged)
            extra["log_perplexity"] = pa.array(extra["log_perplexity"], mask=np.isnan(extra["log_perplexity"]))
            yield with_columns(part, extra, () if keep_text else (text_col,))
        del table
        give_back()

    kept = [f for f in docs.schema if keep_text or f.name != text_col]
    return batched(docs).mapInArrow(run, with_names(kept, MEASURES + ", text_key long" * keys))


def counted(docs: DataFrame, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with the base counts and ``text_key``, which equal texts share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
            rolling = Rolling(data)
            return base_counts(data, offsets, rolling) | {"text_key": wordgrams.text_keys(data, offsets, rolling)}

        for part in pieces(batches, text_col):
            yield with_columns(part, _per_part(part.column(text_col), found), () if keep_text else (text_col,))

    kept = [f for f in docs.schema if keep_text or f.name != text_col]
    extra = MEASURES.replace("log_perplexity double", "text_key long")
    return batched(docs).mapInArrow(run, with_names(kept, extra))


def measure_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with the base counts, ``text_key``, the ``log_perplexity`` of a token by a model of word
    n-grams (null for texts without a token) and ``log_characters``, that of a character by the ``fold_models``."""
    rows = measure(docs.drop("log_perplexity", "log_characters"), fold_models(docs, text_col), text_col, keep_text=False, keys=True)
    rows = rows.withColumnRenamed("log_perplexity", "log_characters")
    return rows.join(wordgrams.log_perplexities(docs, text_col), "text_key", "left")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def bands(measured: DataFrame, lang_col: str = "lang", spread: float = 3.0, lower: str = "log_perplexity") -> DataFrame:
    """``low`` of ``lower`` and ``high`` of the log perplexity of each language, over all its documents that pass the base rules.

    The bands lie ``spread`` interquartile ranges outside the quartiles, so they follow the bulk of a language and
    not its outliers. The quartiles are exact for values rounded to 1e-4, of which there are few. Documents without
    a language form one group. With word n-grams near copies make a text predictable, which is no fault of it; there
    ``lower`` is the log perplexity of characters, which a copy hardly moves and monotonous text does.
    """
    quartiles = [F.percentile(F.round(c, 4), F.array(F.lit(0.25), F.lit(0.75))).alias(n) for c, n in ((lower, "l"), ("log_perplexity", "q"))]
    found = measured.where(~base_failed()).groupBy(F.col(lang_col).alias("band_lang")).agg(*quartiles)
    below, above = (spread * (F.col(c)[1] - F.col(c)[0]) for c in ("l", "q"))
    return found.select("band_lang", (F.col("l")[0] - below).alias("low"), (F.col("q")[1] + above).alias("high"))


def judge(measured: DataFrame, limits: DataFrame, lang_col: str = "lang", lower: str = "log_perplexity") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``: base rules passed and perplexity within the language's band, ``lower``
    above its lower and ``log_perplexity`` below its upper limit.

    The mean over few characters varies by chance; the band is wider by 1 / sqrt(characters in words). A language
    without a band accepts every perplexity.
    """
    rows = stored(limits, "bands")
    joined_rows = measured.join(small(rows), measured[lang_col].eqNullSafe(rows["band_lang"]), "left")
    slack = 1 / F.sqrt(F.greatest("word_chars", F.lit(1)))
    inside = (F.col(lower) >= F.col("low") - slack) & (F.col("log_perplexity") <= F.col("high") + slack)
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return joined_rows.withColumn("base_failed", base_failed()).withColumn("kept", kept).drop("band_lang", "low", "high")
