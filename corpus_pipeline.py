"""From raw documents to token ids: quality rules, near-duplicates, secrets, mixing, byte-level BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.functions.aggregates import small
from tabscope.llm import bpe, minhash, mixing, perplexity, secrets
from tabscope.llm.frames import read, stored
from tabscope.llm.queries import vocabulary


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns numbered, so that those an operator adds cannot clash with them."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def _at(docs: DataFrame, name: str) -> str:
    return f"c{docs.columns.index(name)}"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band; same columns.

    Null and empty texts have no words and go. The model and the bands are made from all of ``docs``.
    """
    rows, text, lang = _numbered(docs), _at(docs, "text"), _at(docs, "lang")
    narrow = stored(perplexity.measure_words(rows.select(text, lang), text), "measured")
    limits = perplexity.bands(narrow, lang, lower="log_characters")
    judged = perplexity.judge(narrow, limits, lang, lower="log_characters")
    rejected = judged.where("NOT base_failed AND NOT kept").select(F.col("text_key").alias("key"), F.col(lang).alias("key_lang"))
    rejected = small(stored(rejected.distinct(), "rejected"))
    passed = perplexity.counted(rows, text).where(~perplexity.base_failed())
    same = (F.col("text_key") == F.col("key")) & F.col(lang).eqNullSafe(F.col("key_lang"))
    return passed.join(rejected, same, "left_anti").select(*rows.columns).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8); same columns."""
    return minhash.without_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by a mark and ``n_chars`` as it is then; same columns."""
    clean = secrets.redact(docs)
    length = F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars"))
    return clean.withColumn("n_chars", length).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn so that tokens meet the target shares of source, language and topic; same columns.

    A document of a cell with too little weight is repeated, as rows with its id; one of a cell with too much may go.
    """
    rows = _numbered(docs)
    margins = (_at(docs, "source"), _at(docs, "lang"), "topic")
    mixed = mixing.mix_documents(rows, margins=margins, id_col=_at(docs, "doc_id"), text_col=_at(docs, "text"))
    repeated = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*rows.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``source``, ``lang``, ``n_chars``, the number of tokens, their ids and the offsets of their ends in the
    text's bytes, and ``decoded_sha256``, the digest of the bytes that the ids decode to (null text: empty)."""
    rows = docs.select("doc_id", "source", "lang", "n_chars", "text")
    tokens = bpe.encode(rows, vocabulary(), keep_text=False)
    decoded = bpe.decode(tokens, vocabulary())
    return decoded.select(
        "doc_id", "source", "lang", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "ends",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The perplexity model, the groups of near-duplicates and the merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
