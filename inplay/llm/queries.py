"""The registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from inplay.llm import bpe, bytecnn, fingerprints, html, language, licenses, lines, minhash, packing, quality, spelling, substrings, trie
from inplay.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.pack(rows)


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_by_next(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.deduplicate_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.char_length("kept").cast("long").alias("n_kept_chars"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), decoded="text")
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.identified(docs).withColumn("held_out", language.held_out("doc_id"))
    return found.select("doc_id", "held_out", F.col("_language.lang").alias("lang_pred"), "_language.score", "_language.rejected")


def op11_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bytecnn.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), least_chars=7, least_count=2, typos=31))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    convs = conversations.select("conv_id").where("conv_id IS NOT NULL")
    return trie.prefix_trie(trie.rebuilt(trie.ordered_turns(conversations), convs), convs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def oracle_sql() -> dict[str, str]:
    """SQL for what another engine can compute; the others are tested against plain versions."""
    return {
        "op3_substring_dedup": substrings.oracle(), "op4_license_scan": licenses.oracle(), "op7_quality_rules": quality.oracle(),
        "op12_spelling_variants": spelling.oracle(), "op13_prefix_trie": trie.oracle()}
