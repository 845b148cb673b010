"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A document's shingles are its distinct runs of five words (A-Z lower-cased); its
fingerprint is the sorted list of the k smallest 64-bit hashes. Sketches of
parts merge into the sketch of the whole (the k smallest of their union). The
union's sketch is a uniform sample of the union's shingles, so the share of it
found in both documents estimates their resemblance; with fewer than k shingles
the numbers are exact.

Only DataFrame functions run: a sketch is one expression over its row, without
any shuffle. Defined results: NULL and empty texts have no shingle and the
empty fingerprint; two empty sketches resemble each other fully, an empty and
another one not at all; fewer than five words are one shingle; equal texts have
equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, let, shingle_hashes, with_global_index, word_array

SHINGLE = 5
K = 128


def sketch(text: Column, k: int = K, size: int = SHINGLE) -> Column:
    """The k smallest distinct shingle hashes of a text, ascending."""
    hashes = F.array_distinct(shingle_hashes(word_array(ascii_lower(text)), size))
    return F.slice(F.sort_array(hashes), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sets from their sketches."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_parts(parts: DataFrame, key: str, column: str = "sketch", k: int = K) -> DataFrame:
    """Sketch per key from any number of part sketches.

    The k smallest hashes are taken map-side first (a ranked limit per key), so a
    key with very many parts reaches its task as k rows per partition.
    """
    lowest = Window.partitionBy(key).orderBy("_hash")
    ranked = (parts.select(key, F.explode(column).alias("_hash")).distinct()
              .withColumn("_rank", F.row_number().over(lowest)).where(F.col("_rank") <= k))
    return ranked.groupBy(key).agg(F.sort_array(F.collect_list("_hash")).alias(column))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness, 0 to 1."""
    return let(merge(a, b, k), lambda union: F.when(F.size(union) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has: |A n B| / |A|, from the sketches."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles (exact below k): (k - 1) / k-th smallest as a share of the range."""
    share = (F.element_at(a, F.size(a)).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def as_text(a: Column) -> Column:
    """The sketch as one string: base64 of its 64-bit hashes in order."""
    return F.regexp_replace(
        F.base64(F.unhex(F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), ""))), r"\s", "")


def with_next(rows: DataFrame) -> DataFrame:
    """Every (row_key, text_hash) with the key of the next document, ascending, the last followed by the first.

    Works on keys and lengths only; copies of a whole row are one document. NULL
    ids come last, equal ids are ordered by the hash of their text.
    """
    keys = rows.groupBy("row_key", "text_hash").agg(F.first("doc_id").alias("doc_id"), F.first("n_chars").alias("n_chars"))
    placed = with_global_index(keys, [F.col("doc_id").asc_nulls_last(), F.col("text_hash"), F.col("row_key")], "place")
    count = max(1, placed.count())
    following = placed.select(F.col("place").alias("_place"), F.col("row_key").alias("next_key"), F.col("text_hash").alias("next_hash"))
    return placed.withColumn("_place", (F.col("place") + 1) % count).join(following, "_place").drop("_place", "place", "doc_id")


def edited_fingerprints(docs: DataFrame, k: int = K, size: int = SHINGLE) -> DataFrame:
    """Fingerprint of every text and of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) code points replaced by the
    first as many of the next document's. Every document sends that passage and
    its own sketch to the one before it, so a text is moved once, its passage at
    most half as far again.
    """
    # a row is named by two hashes that are never NULL, so that the joins and the
    # removal of copies are dealt by the same columns and passages move once
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
            .withColumn("row_key", F.xxhash64("doc_id", "text_hash")))
    follows = with_next(rows.withColumn("n_chars", F.length("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")

    lead = follows.select(F.col("row_key").alias("to_key"), F.col("text_hash").alias("to_hash"), half.alias("half"), "next_key", "next_hash")
    is_next = (rows["row_key"] == lead["next_key"]) & (rows["text_hash"] == lead["next_hash"])
    given = (rows.join(lead, is_next)
             # naming the giver keeps both sides' columns alike, so that the texts are shuffled once for both joins
             .select("to_key", "to_hash", "half", F.col("doc_id").alias("next_doc_id"), F.substring(F.col("text"), F.lit(1), F.col("half")).alias("passage"),
                     sketch(F.col("text"), k, size).alias("next_sketch"))
             .dropDuplicates(["to_key", "to_hash"]))
    is_own = (rows["row_key"] == given["to_key"]) & (rows["text_hash"] == given["to_hash"])
    kept = F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - F.col("half"))
    edited = (rows.join(given, is_own).withColumn("n_chars", F.length("text").cast("long"))
              .withColumn("edited", F.concat(kept, "passage")))
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                         sketch(F.col("text"), k, size).alias("sketch"), sketch(F.col("edited"), k, size).alias("edited_sketch"), "next_sketch", "next_doc_id")
