"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kickstar.llm import collocations, conversation_repair, decontaminate, licenses, line_dedup, mixing, ngram_join, quality, suffix_dedup, token_blocks, urlrules, warc
from kickstar.llm.common import scratch, space_words, table, words
from kickstar.llm.token_rollup import Rollup
from kickstar.session import configure

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages to bundles and read the archives back."""
    path = scratch(spark, "warc")
    warc.write_bundles(table(spark, sf_dir, "pages"), path)
    return warc.read_bundles(spark, path, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "source", "copy", F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars"), "shuffle_key")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Write the token files of all documents and read them back."""
    path = scratch(spark, "tokens")
    token_blocks.write_tokens(table(spark, sf_dir, "documents") if docs is None else docs, path, tokenizer_path())
    return token_blocks.with_starts(token_blocks.read_tokens(spark, path, with_ids=False)).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, count those of labelled quality anew with the second tokenizer,
    delete the toxic ones, and send the second batch again.

    The tokenizers are word splitters chosen for the SQL check, so ``n_tokens`` are word
    counts; the rollup takes the counts of any tokenizer."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    row = ("doc_id", "source", "lang")
    load = docs.select(*row, F.lit("space-words-1").alias("tokenizer"), F.size(space_words(F.col("text"))).alias("n_tokens"),
                       F.lit(False).alias("deleted"))
    good = labels.filter("quality = 1").select("doc_id").distinct()
    revised = docs.join(good, "doc_id", "left_semi").select(*row, F.lit("words-2").alias("tokenizer"),
                                                           F.size(words(F.col("text"))).alias("n_tokens"), F.lit(False).alias("deleted"))
    none = F.lit(None).cast("string")
    toxic = labels.filter("toxic = 1").select("doc_id", none.alias("source"), none.alias("lang"), none.alias("tokenizer"),
                                              F.lit(0).alias("n_tokens"), F.lit(True).alias("deleted"))
    store = Rollup(spark, scratch(spark, "rollup"))
    for batch, changes in (("load", load), ("revised", revised), ("toxic", toxic), ("revised", revised)):
        store.apply(batch, changes)
    return store.totals()


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage the conversations and repair them."""
    rows = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damaged(rows), rows)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_warc, op2_license_scan, op3_quality_rules, op4_url_rules, op5_mixing, op6_decontamination, op7_ngram_jaccard,
    op8_token_files, op9_line_dedup, op10_token_counts, op11_suffix_dedup,
    op12_collocations, op13_conversation_repair)}


def queries() -> dict[str, Query]:
    def configured(f: Query) -> Query:
        return lambda spark, sf_dir: f(configure(spark), sf_dir)
    return {name: configured(f) for name, f in QUERIES.items()}
