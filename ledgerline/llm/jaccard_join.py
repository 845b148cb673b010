"""N-gram Jaccard join in metric space: pivots, Voronoi regions, windows, recursion, exact.

A document's set holds its distinct word n-grams (A-Z lower-cased) as 64-bit
hashes. 1 - likeness is a metric d, and documents link when d <= r. Rows of
equal sets are one point from the start.

Unrelated texts are all at distance 1 from each other, where no pivot tells
them apart. So the space falls first into blocks: shingles are put in one order,
rare ones first (by a sketch of 2^18 counts over the whole table; any
order would do for exactness), and sets that link share one of the first
n - ceil(percent * n / 100) + 1 shingles. A point's place in that order also bounds
what it can share: the two sets have nothing in common before their first common
shingle.

One pivot per block then links what lies within r of it. Blocks that still hold
points of different components are split, all at once in each step:

* pivots are drawn per block and every point gets its exact distance to them;
* a point belongs to the region of its nearest pivot, or to the outside if none
  is within ``REACH_STEPS`` times r; the outside counts as a pivot at that constant distance;
* d(y, p) <= d(y, q) + 2r for any y that links with a point of p's region and is
  itself nearest to q, so each point is also put into every region whose pivot
  lies in that window. A region is a block of the next step; pivots have met
  their whole block and leave it;
* inside a region two points are compared only if their distances to its pivot
  differ by r at most and the region is the home of one of them.

Where the windows overlap so much that the regions would hold more than
``COPIES`` times the block, or one of them more than three quarters of it, and
where a block is small, it is joined as it is: more and more of its points meet
all the others of another component. That ends when every block belongs to one
component; no point, pair or partner is ever capped.

What moves: the first shingles of each set once, the sets of points that share a
block, and one set per compared pair. What is collected is the sketch.

Defined results: NULL and empty texts and texts without words have an empty set
and link with nothing; rows with a NULL id link with nothing and have a NULL
component_id; equal sets link; of different texts under one id the set with the
smallest digest is compared, the others link with equal sets only, and all rows
of the id are in one component; fewer words than n are one shingle; likeness
ties at the threshold link (integer arithmetic); very long texts are whole sets;
an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerline.llm.sets import (SetReader, connected, digest_of, first_shingles, mix64, points_of, rarity, with_components,
                                 words_of)
from ledgerline.sources.tables import materialize

SHINGLE = 4
PERCENT = 85
REACH_STEPS = 4              # the outside begins at 4 r
PIVOTS = 8                   # per block and step
SMALL = 96                   # points of a block that is joined as it is
COPIES = 1.5                 # a split may hold so many times the block's points
GROWTH = 16                  # of the points that meet all others, by round
MARGIN = 1e-9                # of floating-point bounds; links themselves are decided in integers

_STEP = np.uint64(0x9E3779B97F4A7C15)


# ------------------------------------------------------------------ sets
def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``size`` words (or of all, if fewer)."""
    from xxhash import xxh64_intdigest
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    run = min(size, len(h))
    n = len(h) - run + 1
    runs = np.full(n, run, np.uint64)     # a short text's one shingle is no run of ``size``
    for j in range(run):
        runs = runs * _STEP + mix64(h[j:j + n] + np.uint64(j))
    return np.unique(mix64(runs))


def set_of(size: int):
    """A text's set of word n-grams, A-Z lower-cased."""
    return lambda text: shingle_set(words_of(text), size)


def _prefixed(size: int, percent: int, counts: np.ndarray):
    """An Arrow function (doc_id, text) -> (doc_id, n_shingles, digest, first): the set's rarest shingles, rarest first."""
    of = set_of(size)

    def prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for start in range(0, len(ids), 1024):
                part = ids[start:start + 1024]
                found = [of(texts[start + i].as_py()) for i in range(len(part))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int64()), pa.array(list(map(len, found)), pa.int64()), pa.array(list(map(digest_of, found)), pa.binary()),
                     pa.array([first_shingles(s, counts, percent).astype(np.int64, copy=False) for s in found], pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "digest", "first"])

    return prefixed


# ----------------------------------------------------------------- blocks
def blocks_of(points: DataFrame) -> DataFrame:
    """(key, id, n, pos, score): the blocks that hold two points at least.

    ``pos`` is the block's place among the point's first shingles; ``score``
    the company in all its blocks (a point has one block per first shingle at most).
    """
    thrown = points.select("id", "n", F.posexplode("first").alias("pos", "key"))
    shared = materialize(thrown.groupBy("key").agg(F.count("*").alias("company")).where("company > 1"), "shared")
    company = thrown.join(shared, "key")
    return company.withColumn("score", F.sum("company").over(Window.partitionBy("id"))).drop("company")


def _possible(percent: int, other: str) -> Column:
    """Whether two points of a block can link if the block is their first common shingle."""
    shared = F.least(F.col("n") - F.col("pos"), F.col(f"{other}_n") - F.col(f"{other}_pos"))
    return 100 * shared >= percent * (F.col("n") + F.col(f"{other}_n") - shared)


def _mixed(members: DataFrame) -> DataFrame:
    """Members of blocks that hold two components at least."""
    keys = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    return members.join(keys.select("key"), "key", "left_semi")


class Join:
    """The running state of one join: links found so far and their components."""

    def __init__(self, reader: SetReader):
        self.reader, self.percent, self.edges, self.labels = reader, reader.percent, None, None
        self.r = 1 - reader.percent / 100

    def distances(self, pairs: DataFrame, links_only: bool = True) -> DataFrame:
        """(id, pivot, shared, total) of distinct pairs; those that link are remembered."""
        found = self.reader.overlaps(pairs, links_only)
        links = self.reader.linked(found).select(F.col("id").alias("a"), F.col("pivot").alias("b"))
        if links.take(1):
            self.edges = links if self.edges is None else self.edges.unionByName(links)
            self.labels = materialize(connected(self.edges), "labels")
            # links between components say as much as all links
            self.edges = self.labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        return found

    def relabelled(self, members: DataFrame) -> DataFrame:
        if self.labels is None:
            return members
        return (members.drop("label").join(self.labels, members["id"] == self.labels["node"], "left")
                .withColumn("label", F.coalesce("label", "id")).drop("node"))

    def open(self, members: DataFrame) -> DataFrame:
        return materialize(_mixed(materialize(self.relabelled(members), "members")), "members")

    # ---------------------------------------------------------- first pivot
    def collapse(self, members: DataFrame) -> DataFrame:
        """Link what lies within r of one pivot per block; members of blocks that stay open, without those pivots."""
        best = members.groupBy("key").agg(F.max_by(F.struct("id", "n", "pos"), F.struct("score", -F.col("id"))).alias("p")).select(
            "key", F.col("p.id").alias("pivot"), F.col("p.n").alias("pivot_n"), F.col("p.pos").alias("pivot_pos"))
        met = members.join(best, "key")
        pairs = met.where((F.col("id") != F.col("pivot")) & _possible(self.percent, "pivot"))
        self.distances(once(pairs))
        return self.open(met.where("id <> pivot").select(*members.columns))

    # -------------------------------------------------------------- regions
    def split(self, members: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
        """Blocks of ``members`` by Voronoi regions: (regions, blocks that the windows don't part)."""
        r, reach = self.r, REACH_STEPS * self.r
        drawn = F.xxhash64("id", F.lit(turn))     # any points: the best ones tend to lie together
        pivots = materialize(members.groupBy("key", F.pmod(drawn, F.lit(PIVOTS)).alias("g")).agg(F.min_by("id", drawn).alias("p"))
                             .groupBy("key").agg(F.sort_array(F.collect_list("p")).alias("pivots")), "pivots")
        met = members.join(pivots, "key")
        wanted = met.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_set("pivots"))).alias("pivots"))
        pairs = wanted.select("id", F.explode("pivots").alias("pivot")).where("id <> pivot")
        found = self.distances(once(pairs), links_only=False)
        both = found.unionByName(found.select(F.col("pivot").alias("id"), F.col("id").alias("pivot"), "shared", "total"))
        # of its own blocks' pivots only: a pivot does not gather all that it met
        asked = wanted.select("id", F.explode("pivots").alias("pivot"))
        known = both.join(asked, ["id", "pivot"], "left_semi").groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct(
            "pivot", 1 - F.col("shared") / F.col("total")))).alias("known"))

        rest = met.where(~F.array_contains("pivots", F.col("id"))).join(known, "id")
        far = rest.select("*", F.transform("pivots", lambda p: F.element_at("known", p)).alias("d")).drop("known")
        nearest = far.withColumn("least", F.least(F.array_min("d"), F.lit(reach)))
        homes = nearest.withColumn("at_home", F.when(F.array_min("d") <= reach, F.get("pivots", F.array_position("d", F.array_min("d")).cast("int") - 1)))
        outside = F.struct(F.lit(None).cast("long").alias("pivot"), F.lit(None).cast("double").alias("near"))
        inside = F.filter(F.arrays_zip(F.col("pivots").alias("pivot"), F.col("d").alias("near")), lambda z: z["near"] <= F.least(
            F.col("least") + 2 * r, F.lit(reach + r)) + MARGIN)
        # what links with a point of the outside is further than reach - r from every pivot
        regions = F.when(F.col("least") >= reach - r - MARGIN, F.concat(inside, F.array(outside))).otherwise(inside)
        placed = homes.withColumn("regions", regions)
        placed = materialize(placed, "placed")
        sizes = placed.select("key", F.explode("regions.pivot").alias("pivot")).groupBy("key", "pivot").agg(F.count("*").alias("n"))
        fits = placed.groupBy("key").agg(F.count("*").alias("of")).join(
            sizes.groupBy("key").agg(F.sum("n").alias("copies"), F.max("n").alias("most")), "key").select(
            "key", ((F.col("copies") <= COPIES * F.col("of")) & (4 * F.col("most") <= 3 * F.col("of"))).alias("fits"))
        judged = self.relabelled(materialize(placed.join(fits, "key"), "regions"))
        whole = judged.where("NOT fits").select(*members.columns)
        moved = judged.where("fits").select("*", F.explode("regions").alias("region"))
        parts = moved.select(
            F.xxhash64("key", F.coalesce(F.col("region.pivot"), F.lit(-1))).alias("key"), "block", "id", "n", "pos", "score", "label",
            (F.col("region.pivot").eqNullSafe(F.col("at_home"))).alias("home"), F.col("region.near").alias("near"))
        return parts.select(*members.columns), whole

    # ------------------------------------------------------------ whole blocks
    def finish(self, members: DataFrame) -> None:
        """Join the blocks as they are: chosen points meet all others of another component."""
        groups, turn = GROWTH, 0
        while members.take(1):
            small = F.count("*").over(Window.partitionBy("key")) <= SMALL
            grouped = members.withColumn("g", F.when(small, F.col("id")).otherwise(F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(groups))))
            chosen = grouped.groupBy("key", "g").agg(F.max_by(
                F.struct("id", "n", "pos", "label", "home", "near"), F.struct("score", -F.col("id"))).alias("p"))
            chosen = materialize(chosen.select("key", *[F.col(f"p.{c}").alias(f"pivot_{c}") for c in ("id", "n", "pos", "label", "home", "near")]), "chosen")
            met = members.join(chosen, "key").where(
                (F.col("label") != F.col("pivot_label")) & _possible(self.percent, "pivot")
                & (F.col("home") | F.col("pivot_home"))
                & F.coalesce(F.abs(F.col("near") - F.col("pivot_near")) <= self.r + MARGIN, F.lit(True)))
            self.distances(once(met.select("id", F.col("pivot_id").alias("pivot"))))
            left = members.join(chosen.select("key", F.col("pivot_id").alias("id")), ["key", "id"], "left_anti")
            members = self.open(left)
            groups, turn = groups * GROWTH, turn + 1


def once(pairs: DataFrame) -> DataFrame:
    """Distinct pairs, whichever of the two was the pivot (the larger id, if both were)."""
    both = pairs.groupBy(F.least("id", "pivot").alias("low"), F.greatest("id", "pivot").alias("high")).agg(F.max("pivot").alias("pivot"))
    return both.select(F.when(F.col("pivot") == F.col("high"), F.col("low")).otherwise(F.col("high")).alias("id"), "pivot")


def members_of(blocks: DataFrame) -> DataFrame:
    """Blocks as members of a join: every point is its own component and at home."""
    return materialize(blocks.select(
        "key", F.col("key").alias("block"), "id", "n", "pos", "score", F.col("id").alias("label"),
        F.lit(True).alias("home"), F.lit(None).cast("double").alias("near")), "members")


def _size(members: DataFrame) -> DataFrame:
    return members.withColumn("size", F.count("*").over(Window.partitionBy("key")))


def components(points: DataFrame, reader: SetReader) -> DataFrame | None:
    """(node, label) of the points (id, n, first) that link with another one; None if none does."""
    members = members_of(blocks_of(points))
    if not members.take(1):
        return None
    join = Join(reader)
    members = join.collapse(members)
    done, turn = None, 1
    while True:
        sized = _size(members)
        large = sized.where(F.col("size") > SMALL).drop("size")
        small = sized.where(F.col("size") <= SMALL).drop("size")
        done = small if done is None else done.unionByName(small)
        if not large.take(1):
            break
        parts, whole = join.split(large, turn)
        done = done.unionByName(whole)
        members = join.open(parts)
        turn += 1
    join.finish(join.open(done))
    return join.labels


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                       percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (the smallest id reachable over links)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = rarity(source, set_of(size))
    known = materialize(source.mapInArrow(
        _prefixed(size, percent, counts), "doc_id long, n_shingles long, digest binary, first array<bigint>"), "firsts")
    points, names = points_of(known, ["first"])
    return with_components(known, names, components(points, SetReader(source, points, set_of(size), percent)))
