"""One query per operator over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (conversations, extraction, fingerprints, infilling, jaccard_join, licenses, minhash, mixing, packing, quality, sharding, tokens, warc)
from ledgerline.sources.tables import materialize, read_table

SHARDS = 8


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return tokens.with_token_counts(docs, tokens.tokenizer_path("byte_bpe_50k.json")).drop("text")


def op3_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.write_archives(read_table(spark, sf_dir, "pages"))
    return warc.read_archives(manifest, with_payload=False).drop("url")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fingerprints
    rows = f.edited_fingerprints(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", f.as_text(F.col("sketch")).alias("fingerprint"),
        f.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        f.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        f.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"), "next_doc_id")


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "source", "text"])
    return mixing.with_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(read_table(spark, sf_dir, "pages")).drop("html")


def op7_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(text, "utf-8")).alias("text_crc32"), F.xxhash64(text).alias("text_hash"))
    return sharding.shard_by_bytes(rows, "text_hash", "doc_id", "size", SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op9_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return packing.pack(docs, tokens.tokenizer_path("word_bpe_49k.json"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "lang", "source", "text"])
    return quality.judge(docs).drop("lang", "source")


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = materialize(conversations.turn_lists(read_table(spark, sf_dir, "conversations")), "turn-lists")
    return conversations.prefix_trie(conversations.paths_of(conversations.rebuilt(lists)))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = infilling.fill_in_middle(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))
    return dealt.select(
        "doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
        F.sha2(F.encode("output", "utf-8"), 256).alias("output_sha256"),
        F.sha2(F.encode(infilling.restored(F.col("output"), F.col("form")), "utf-8"), 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_token_counts, op3_warc_packages, op4_fingerprints, op5_source_mix, op6_main_text,
        op7_byte_shards, op8_near_duplicates, op9_packed_sequences, op10_quality_rules, op11_jaccard_join, op12_prefix_trie, op13_fill_in_middle)}

SQL: dict[str, str] = {
    "op1_license_scan": licenses.oracle_sql(),
    "op5_source_mix": mixing.oracle_sql(),
    "op12_prefix_trie": conversations.oracle_sql(),
    "op13_fill_in_middle": infilling.oracle_sql(),
}
