"""Mixing sources to target weights: token weights raked to marginals, then documents drawn by them. SQL functions only."""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.functions.aggregates import small
from tabscope.llm.frames import stored

MARGINS = ("source", "lang", "topic")
# Without given targets a category of share s is wanted with a share in proportion to s ** POWER.
POWER = 0.8
# Raking ends when every margin is met to this relative error, or with a warning after so many rounds.
TOLERANCE, MAX_ROUNDS = 1e-4, 300
SEED = "mix"

# The topic of a text is that of the first rule whose expression it contains.
TOPICS = {
    "licence": r"(?i)licen[sc]e|rights reserved",
    "table": r" \| ",
    "contact": r"@[a-z]",
    "numbers": r"[0-9]{4}",
}
OTHER_TOPIC = "prose"


def topic_of(text: Column) -> Column:
    rules = F.lit(OTHER_TOPIC)
    for name, pattern in reversed(TOPICS.items()):
        rules = F.when(F.coalesce(text, F.lit("")).rlike(pattern), name).otherwise(rules)
    return rules


def token_weight(text: Column) -> Column:
    """A quarter of the UTF-8 bytes, rounded up: the usual yield of a byte-level vocabulary, at no cost."""
    return F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4).cast("long")


def _matched(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Inner join on keys whose nulls are equal; the keys of ``left`` stay."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(other[f"__r_{k}"])
    return left.join(other, condition).drop(*[f"__r_{k}" for k in keys])


def rake(
    cells: DataFrame, margins: tuple[str, ...] = MARGINS, targets: Mapping[str, Mapping[str | None, float]] | None = None,
    power: float = POWER, tolerance: float = TOLERANCE, rounds: int = MAX_ROUNDS,
) -> DataFrame:
    """``cells`` (margins, ``tokens``) with ``weight``: the share of tokens that meets all target marginals.

    Iterative proportional fitting: each step scales the weights of a margin's categories to their targets, starting
    from the shares as they are, until all margins are met within ``tolerance``. Targets that no weights of the given cells
    meet together end after ``rounds`` with a warning. ``targets`` gives wanted weights by margin and category, normalised over the
    categories present; a category without one is wanted with 0. Other margins get their share to the ``power``.
    Sums are combined before they are moved, so a margin with few categories is no bottleneck. A null is a
    category. Cells without tokens keep weight 0.
    """
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    rows = cells.withColumn("weight", F.col("tokens") / F.lit(float(max(total, 1))))
    for k, margin in enumerate(margins):
        shares = rows.groupBy(margin).agg(F.sum("weight").alias("share"))
        if targets and margin in targets:
            wanted = F.lit(0.0)
            for category, value in targets[margin].items():
                wanted = F.when(F.col(margin).eqNullSafe(F.lit(category)), F.lit(float(value))).otherwise(wanted)
        else:
            wanted = F.pow("share", F.lit(power))
        shares = shares.select(margin, wanted.alias("wanted"))
        norm = shares.agg(F.sum("wanted")).first()[0] or 1.0
        shares = shares.select(margin, (F.col("wanted") / F.lit(norm)).alias(f"target_{k}"))
        rows = _matched(rows, shares, (margin,))
    rows = stored(rows, "cells")
    for _ in range(rounds):
        rows = rows.withColumn("off", F.lit(0.0))
        for k, margin in enumerate(margins):
            sums = rows.groupBy(margin).agg(F.sum("weight").alias("sum"))
            target = F.col(f"target_{k}")
            scaled = F.col("weight") * target / F.col("sum")
            rows = _matched(rows, sums, (margin,))
            error = F.abs(F.col("sum") - target) / F.when(target > 0, target).otherwise(1.0)
            rows = rows.withColumn("off", F.greatest("off", F.when(F.col("sum") > 0, error).otherwise(0.0)))
            rows = rows.withColumn("weight", F.when(F.col("sum") > 0, scaled).otherwise(0.0)).drop("sum")
        rows = stored(rows, "cells")
        if (rows.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    else:
        warnings.warn("raking ended before all targets were met; they may contradict each other", stacklevel=2)
    return rows.drop("off", *[f"target_{k}" for k in range(len(margins))])


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that depends on the id (null: the empty text) and the seed only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def mix_documents(
    docs: DataFrame, topic: Column | None = None, tokens: Column | None = None, margins: tuple[str, ...] = MARGINS,
    targets: Mapping[str, Mapping[str | None, float]] | None = None, power: float = POWER, tolerance: float = TOLERANCE,
    fraction: float = 1.0, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens``, ``ratio``, ``probability``, ``sampled`` and ``copies``; replaces columns of these names.

    ``ratio`` is the raked share of a document's cell over its present share. ``copies`` says how often a document is
    in the mix: the whole part of ``fraction * ratio``, and once more with its fractional part as probability, so that
    tokens times copies meet the targets. ``sampled`` (with ``probability``, at most 1) tells whether it is there at all; sampled
    rows alone, without their copies, fall short of the targets of underweight cells. The draw depends on the id
    only, so rows with equal ids share it. Documents are joined with the cells by broadcast while these are few, else by
    a shuffle join.
    """
    topic = topic_of(F.col(text_col)) if topic is None else topic
    tokens = token_weight(F.col(text_col)) if tokens is None else tokens
    rows = docs.withColumns({"topic": topic, "tokens": tokens})
    cells = rows.groupBy(*margins).agg(F.sum("tokens").alias("tokens"))
    cells = stored(cells, "cells")
    raked = stored(rake(cells, margins, targets, power, tolerance), "raked")
    total = float(max(cells.agg(F.sum("tokens")).first()[0] or 0, 1))
    ratio = F.when(F.col("tokens") > 0, F.col("weight") * F.lit(total) / F.col("tokens")).otherwise(F.lit(1.0))
    found = small(raked.select(*margins, ratio.alias("ratio")))
    rows = _matched(rows.drop("ratio", "probability", "sampled", "copies"), found, margins)
    wanted, drawn = F.lit(float(fraction)) * F.col("ratio"), draw(F.col(id_col), seed)
    rows = rows.withColumn("probability", F.least(F.lit(1.0), wanted))
    copies = F.floor(wanted) + (drawn < wanted - F.floor(wanted)).cast("long")
    return rows.withColumn("sampled", drawn < F.col("probability")).withColumn("copies", copies)


def sql(power: float = POWER, tolerance: float = TOLERANCE, rounds: int = 24) -> str:
    """The same rounds, of which those after the one that met the tolerance change nothing."""
    rules = " ".join(f"WHEN regexp_matches(coalesce(text, ''), '{p}') THEN '{name}'" for name, p in TOPICS.items())
    parts = [f"""docs AS (SELECT doc_id, source, lang, CASE {rules} ELSE '{OTHER_TOPIC}' END AS topic,
      ceil(coalesce(strlen(text), 0) / 4)::BIGINT AS tokens FROM documents),
    cells AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL),
    w0 AS (SELECT *, tokens / greatest(sum(tokens) OVER (), 1) AS weight, 0::DOUBLE AS off, false AS done FROM cells),"""]  # fmt: skip
    for k, margin in enumerate(MARGINS):
        parts.append(f"""t{k} AS (SELECT {margin}, pow(sum(weight), {power}) AS wanted FROM w0 GROUP BY ALL),
    n{k} AS (SELECT {margin}, wanted / sum(wanted) OVER () AS target FROM t{k}),""")
    last = "w0"
    for r in range(1, rounds + 1):
        for k, margin in enumerate(MARGINS):
            parts.append(f"""w{r}_{k} AS (SELECT source, lang, topic, tokens, done,
      greatest(off, CASE WHEN s > 0 THEN abs(s - target) / CASE WHEN target > 0 THEN target ELSE 1 END ELSE 0 END) AS off,
      CASE WHEN done THEN weight WHEN s > 0 THEN weight * target / s ELSE 0 END AS weight
      FROM (SELECT c.*, n.target, sum(c.weight) OVER (PARTITION BY c.{margin}) AS s
        FROM {last} c JOIN n{k} n ON c.{margin} IS NOT DISTINCT FROM n.{margin})),""")
            last = f"w{r}_{k}"
        parts.append(f"w{r} AS (SELECT * EXCLUDE (off, done), 0::DOUBLE AS off, done OR max(off) OVER () <= {tolerance} AS done FROM {last}),")
        last = f"w{r}"
    return f"""WITH {" ".join(parts)}
    r AS (SELECT *, CASE WHEN tokens > 0 THEN weight * (sum(tokens) OVER ()) / tokens ELSE 1.0 END AS ratio FROM {last}),
    p AS (SELECT d.*, r.ratio, least(1.0, r.ratio) AS probability,
      ('0x' || substr(md5('{SEED}' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS drawn FROM docs d JOIN r
      ON d.source IS NOT DISTINCT FROM r.source AND d.lang IS NOT DISTINCT FROM r.lang AND d.topic = r.topic)
    SELECT doc_id, source, lang, topic, tokens, round(ratio, 6) AS ratio, round(probability, 6) AS probability,
      drawn < probability AS sampled, (floor(ratio) + (drawn < ratio - floor(ratio))::INTEGER)::BIGINT AS copies
    FROM p"""
