"""Corpus pipeline: quality rules, near-dedup, source mixing, packing.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written
and read again as the next stage's documents. All but the last return the
columns of documents.

Defined results, for every stage: NULL texts are empty texts and NULL ids, sources
and languages are values of their own; very long texts are taken whole; an empty
table gives an empty result with the same columns; further columns pass through
all stages but the last.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import minhash, mixing, packing, quality, tokens
from ledgerline.llm.sets import held
from ledgerline.session import checkpoint_dir
from ledgerline.sources.tables import materialize, read_table

NEAR_PERCENT = 80   # op8 links at 85, by its contract


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the outlier test reject go; repeated rows are judged alike."""
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (likeness 0.8 or more) the document with the smallest doc_id stays.

    Of equal rows of that document one stays; rows with a NULL doc_id and texts
    without words are linked with nothing and stay.
    """
    found = minhash.near_duplicates(docs, percent=NEAR_PERCENT, bands=minhash.BANDS_80).select("doc_id", "kept")
    found = materialize(found, "near-dedup").where("doc_id IS NOT NULL")
    # ids that go or come more than once: few beside the documents, whose texts stay where they are
    marked = materialize(found.groupBy("doc_id").agg(F.bool_or(~F.col("kept")).alias("goes"), F.count("*").alias("n"))
                         .where("goes OR n > 1"), "marked")
    repeated = materialize(marked.where("NOT goes").select("doc_id"), "repeated")
    left = docs.join(held(marked.select("doc_id")), "doc_id", "left_anti")
    # only rows of repeated ids are compared with each other
    if repeated.take(1):
        left = left.unionByName(docs.join(held(repeated), "doc_id", "left_semi").dropDuplicates())
    return left.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them; a document without words as often as its source's rate says."""
    return mixing.mix(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences; every row, repeated or not, is packed."""
    return packing.pack(docs, tokens.tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("packing", packed_sequences),
]

# The stages use MCD iterations, sketches and a tokenizer, which SQL can't express;
# tests compare the pipeline with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
