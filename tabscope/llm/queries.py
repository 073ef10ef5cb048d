"""The registered queries of this subpackage, each with its DuckDB SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabscope.llm import bpe, langid, merkle, minhash, mixing, periods, perplexity, quality, repeats, secrets, spelling, urls, warc
from tabscope.llm.frames import read, stored
from tabscope.session import scratch_path

def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _SQL[fn.__name__] = sql
        return fn

    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@query()
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, minhash.Shape(shingle=4))


@query()
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())


@query()
def op4_perplexity_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = stored(perplexity.measure_words(docs), "measured")
    judged = perplexity.judge(measured, perplexity.bands(measured, lower="log_characters"), lower="log_characters")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *counts, "base_failed", "kept", F.exp("log_perplexity").alias("perplexity"))


@query()
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan_secrets(docs).select("doc_id", "secrets")
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in secrets.BASE],
        F.sha2(secrets.listed(F.col("secrets"), secrets.BASE).cast("binary"), 256).alias("base_sha256"),
        secrets.listed(F.col("secrets")).alias("spans"),
    )


@query()
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op9_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    archives = warc.write_archives(pages, scratch_path(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    return warc.read_archives(archives, payloads=False).select(
        F.col("page_id").cast(kind), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind)
    )


@query(merkle.SQL)
def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edited_fingerprints(read(spark, sf_dir, "documents"))


@query(mixing.sql())
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_documents(read(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", "lang", "topic", "tokens", F.round("ratio", 6).alias("ratio"),
        F.round("probability", 6).alias("probability"), "sampled", "copies",
    )


@query()
def op5_crf_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_languages(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query()
def op7_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read(spark, sf_dir, "documents"), keep_text=False)


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return periods.run_digests(docs.withColumn("text", periods.planted(F.col("doc_id"), F.col("text"))))


@query()
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.runs_of_letters(read(spark, sf_dir, "documents"))
    slips = words.select(spelling.slipped(F.col("doc_id"), F.col("word")).alias("word"))
    return spelling.variants(spelling.word_counts(slips)).select("word", "form", "root", "n", "n_near", "form_n")


@query(urls.SQL)
def op13_url_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return urls.judge_urls(pages, urls.rule_table(spark), urls.declared_links(pages))
