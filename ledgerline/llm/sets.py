"""Sets of word shingles that two operators compare: rarest shingles first, and exact sets of compared pairs only."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import materialize

BUCKETS = 1 << 18            # counts of the sketch that orders shingles
BROADCAST_ROWS = 500_000     # of ids and pairs: 20 MB at most

C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

SetOf = Callable[[bytes | None], np.ndarray]    # a text's sorted distinct 64-bit shingle hashes


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit generator: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes | None) -> list[bytes]:
    """A-Z lower-cased words between white space of ASCII."""
    return text.lower().split() if text else []


def bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def digest_of(shingles: np.ndarray) -> bytes:
    from xxhash import xxh3_128_digest
    return xxh3_128_digest(shingles.tobytes())


def first_shingles(shingles: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The n - ceil(percent * n / 100) + 1 rarest shingles, rarest first: sets that reach ``percent`` share one of them."""
    n = len(shingles)
    most = n + percent * -n // 100 + 1 if n else 0
    return shingles[np.lexsort((shingles, counts[bucket(shingles)]))[:most]]


def rarity(source: DataFrame, set_of: SetOf) -> np.ndarray:
    """How many shingles of all texts fall into each bucket: ``BUCKETS`` numbers at most, whatever the table holds."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held, waiting = np.zeros(BUCKETS, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                held.append(bucket(set_of(text.as_py())))
                waiting += len(held[-1])
                if waiting > BUCKETS:
                    counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
                    held, waiting = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=BUCKETS)
        found = np.flatnonzero(counts)
        if len(found):
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(counts[found], pa.int64())], ["bucket", "n"])

    sums = source.select("text").mapInArrow(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()      # columns of numbers: rows of Python objects take the driver 115 MB more
    counts = np.zeros(BUCKETS, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over edges (a, b).

    Alternates two steps that hook neighbours onto the smallest one around a
    node until nothing moves; a star of any size is done in one pair of steps.
    """
    edges = materialize(edges.where("a <> b").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = materialize(small.where("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen:
            return edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
        seen = now


def held(rows: DataFrame) -> DataFrame:
    """Written rows of a few numbers: broadcast if there are ``BROADCAST_ROWS`` at most, else joined by a shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


class SetReader:
    """Exact overlaps of pairs of points.

    ``source`` (doc_id, text) holds the texts, ``points`` (id, digest, rows, n,
    first) one row per compared set: its digest, the rows of its id, its size and
    its first shingles. A set is read from its text when a pair first needs it.
    """

    def __init__(self, source: DataFrame, points: DataFrame, set_of: SetOf, percent: int):
        self.source, self.points, self.set_of, self.percent = source, points, set_of, percent
        self.sets: DataFrame | None = None

    def _read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(doc_id, text, digest, rows) -> (id, rows, shingles) of the texts whose set has that digest."""
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            ids, digests, rows = (batch.column(i).to_pylist() for i in (0, 2, 3))
            for start in range(0, len(ids), 256):
                found = [(i, self.set_of(texts[i].as_py())) for i in range(start, min(start + 256, len(ids)))]
                found = [(i, s) for i, s in found if digest_of(s) == digests[i]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([rows[i] for i, _ in found], pa.int64()),
                     pa.array([s.astype(np.int64, copy=False) for _, s in found], pa.list_(pa.int64()))], ["id", "rows", "shingles"])

    def fetch(self, ids: DataFrame) -> DataFrame:
        """Sets of ``ids``: those not read before come from their texts and are written, each once."""
        new = ids if self.sets is None else ids.join(self.sets.select("id"), "id", "left_anti")
        wanted = materialize(self.points.select("id", "digest", "rows").join(held(materialize(new, "new-ids")), "id"), "ids")
        # texts stay where they are as long as the ids are few
        texts = self.source.join(held(wanted.withColumnRenamed("id", "doc_id")), "doc_id").select("doc_id", "text", "digest", "rows")
        set_reader = SetReader(None, None, self.set_of, self.percent)      # what the tasks need of it
        sets = texts.mapInArrow(set_reader._read, "id long, rows long, shingles array<bigint>")
        # a set of several rows is taken once; the others are not shuffled for that
        once = sets.where("rows = 1")
        if wanted.where("rows > 1").take(1):
            once = once.unionByName(sets.where("rows > 1").dropDuplicates(["id"]))
        read = materialize(once.drop("rows"), "sets")
        self.sets = read if self.sets is None else self.sets.unionByName(read)
        return self.sets.join(held(ids), "id", "left_semi")

    def near(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose first shingles leave it open that they link.

        With c first shingles in common, what two sets share is c and, of the one
        whose first shingles end earlier in the order, the rest at most.
        """
        firsts = self.points.select("id", "n", "first")
        theirs = firsts.select(F.col("id").alias("pivot"), F.col("n").alias("pivot_n"), F.col("first").alias("pivot_first"))
        theirs = theirs.join(held(materialize(pairs.select("pivot").distinct(), "pivots")), "pivot", "left_semi")
        both = firsts.join(held(pairs), "id").join(theirs, "pivot")
        rest = F.greatest(F.col("n") - F.size("first"), F.col("pivot_n") - F.size("pivot_first"))
        common = F.size(F.array_intersect("first", "pivot_first"))
        # sets that link have a first shingle in common
        shared = F.when(common > 0, F.least(common + rest, F.col("n"), F.col("pivot_n"))).otherwise(0)
        return both.where(100 * shared >= self.percent * (F.col("n") + F.col("pivot_n") - shared)).select("id", "pivot")

    def overlaps(self, pairs: DataFrame, links_only: bool = True) -> DataFrame:
        """(id, pivot, shared, total) of distinct pairs (id, pivot); with ``links_only`` perhaps not of pairs that can't link."""
        pairs = materialize(pairs, "pairs")
        if links_only:
            pairs = materialize(self.near(pairs), "near-pairs")
        sets = self.fetch(materialize(pairs.select("id").unionByName(pairs.select(F.col("pivot").alias("id"))).distinct(), "met"))
        mine = sets.select("id", "shingles")
        # few sets stand on the pivots' side: small enough, they are broadcast and the others stay where they are
        pivots = materialize(pairs.select(F.col("pivot").alias("id")).distinct(), "pivots")
        theirs = materialize(sets.join(held(pivots), "id", "left_semi")
                             .select(F.col("id").alias("pivot"), F.col("shingles").alias("pivot_shingles")), "pivot-sets")
        shared = F.size(F.array_intersect("shingles", "pivot_shingles"))
        met = mine.join(held(pairs), "id").join(theirs, "pivot").select(
            "id", "pivot", shared.alias("shared"), (F.size("shingles") + F.size("pivot_shingles")).alias("both"))
        return materialize(met.withColumn("total", F.col("both") - F.col("shared")).drop("both"), "overlaps")

    def linked(self, overlaps: DataFrame) -> DataFrame:
        return overlaps.where(100 * F.col("shared") >= self.percent * F.col("total"))


def points_of(known: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Points and names from (doc_id, n_shingles, digest, ...): rows of equal sets are one point, named by the smallest id.

    Points are one row per id and set that is compared (of different sets under
    one id the one with the smallest digest); names give every digest its id.
    """
    from pyspark.sql import Window
    named = known.where("doc_id IS NOT NULL AND n_shingles > 0")
    repeated = named.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("rows")).where("rows > 1")
    points = materialize(
        named.groupBy("digest").agg(F.min("doc_id").alias("id"), F.first("n_shingles").alias("n"), *[F.first(c).alias(c) for c in keep])
        .withColumn("nth", F.row_number().over(Window.partitionBy("id").orderBy("digest")))
        .join(repeated, "id", "left").withColumn("rows", F.coalesce("rows", F.lit(1))), "points")
    return points.where("nth = 1").drop("nth"), points.select("digest", "id")


def with_components(known: DataFrame, names: DataFrame, labels: DataFrame | None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``known``."""
    if labels is not None:
        names = names.join(labels, names["id"] == labels["node"], "left").select("digest", F.coalesce("label", "id").alias("id"))
    own = known.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    return own.join(names, "digest", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("id", "doc_id")).alias("component_id"))
