"""Sharding by histogram sort: exact byte counts below probes, refined, then one exchange.

The sort key is (hash of the text, doc_id): equal texts lie side by side and a
boundary cuts through a group of copies only where the group itself is larger
than the tolerance. The target of boundary s is s / shards of all bytes. Every
round cuts the interval that holds a boundary into equal parts and counts the
exact bytes of each part over all partitions in one aggregate (a few hundred
sums, added up map-side); the part that holds the target is the next interval.
A boundary is done once the bytes below it are within the tolerance, or its
interval holds a single row. When a single hash value is still too large, the
rounds go on in the doc_ids of that value. Only then are rows exchanged, once,
by range of the key.

Defined results: a NULL text has no bytes and the hash of its NULL; its size is
1; NULL doc_ids sort before all others; rows equal in hash and doc_id cannot be
told apart by the key and stay together; an empty table gives an empty result;
fewer rows than shards leave shards empty; extra columns pass through unless
their name is shard or slot.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import with_global_index
from ledgerline.sources.tables import materialize

HASH_BITS = 62
STEP_BITS = 6            # an interval is cut into 64 parts a round
TOLERANCE = 0.002        # of a shard's bytes
LEAST_ID = -(1 << 63)


@dataclass(frozen=True)
class Interval:
    """Keys in [start, start + 2**bits) at one level: hashes, or the ids of one hash value."""

    start: int
    bits: int
    hash_value: int | None = None

    def part(self, hash_col: Column, id_col: Column) -> Column:
        """Number of the part of this interval that a row lies in, else NULL."""
        step = max(0, self.bits - STEP_BITS)
        if self.hash_value is None:
            inside = (hash_col >= self.start) & (hash_col <= self.start + (1 << self.bits) - 1)
            return F.when(inside, F.shiftright(hash_col - self.start, step))
        # ids span 64 bits, so their distance needs a wider type than a long
        far = id_col.cast("decimal(38,0)") - F.lit(str(self.start)).cast("decimal(38,0)")
        width = F.lit(str(1 << step)).cast("decimal(38,0)")
        return F.when((hash_col == self.hash_value) & (far >= 0) & (far < F.lit(str(1 << self.bits)).cast("decimal(38,0)")),
                      ((far - far % width) / width).cast("long"))  # exact: a decimal quotient would be rounded up


@dataclass(frozen=True)
class Boundary:
    """Rows at or after (hash_value, doc_id) lie above; ``below`` bytes lie under it."""

    hash_value: int
    doc_id: int
    below: int

    def reached(self, hash_col: Column, id_col: Column) -> Column:
        return (hash_col > self.hash_value) | ((hash_col == self.hash_value) & (id_col >= self.doc_id))


def _boundary(interval: Interval, at: int, below: int) -> Boundary:
    return Boundary(at, LEAST_ID, below) if interval.hash_value is None else Boundary(interval.hash_value, at, below)


def find_boundaries(keys: DataFrame, shards: int, tolerance: float = TOLERANCE) -> list[Boundary]:
    """Boundaries of ``shards`` shards of near equal bytes over rows (hash, order_id, size)."""
    hash_col, id_col = F.col("hash"), F.col("order_id")
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    allowed = tolerance * total / shards
    open_: dict[int, tuple[Interval, int]] = {s: (Interval(0, HASH_BITS), 0) for s in range(1, shards)}
    done: dict[int, Boundary] = {}
    while open_:
        intervals = list(dict.fromkeys(i for i, _ in open_.values()))
        place = F.coalesce(*[F.when(part.isNotNull(), F.struct(F.lit(n).alias("n"), part.alias("part")))
                             for n, part in enumerate(i.part(hash_col, id_col) for i in intervals)])
        counted: dict[int, list[tuple[int, int, int]]] = {}
        sums = (keys.select(place.alias("at"), "size").where(F.col("at").isNotNull()).groupBy("at")
                .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")))
        for r in sums.collect():  # one row a part: 64 for each open interval at most
            counted.setdefault(r["at"]["n"], []).append((r["at"]["part"], r["bytes"], r["rows"]))
        for s, (interval, below) in list(open_.items()):
            target, step = total * s / shards, max(0, interval.bits - STEP_BITS)
            for part, size, rows in sorted(counted[intervals.index(interval)]):
                if below + size <= target - allowed:
                    below += size
                    continue
                start = interval.start + (part << step)
                low, high = _boundary(interval, start, below), _boundary(interval, start + (1 << step), below + size)
                near = min(low, high, key=lambda b: abs(b.below - target))
                alone = rows == 1 or (step == 0 and interval.hash_value is not None)
                if abs(near.below - target) <= allowed or alone:
                    done[s] = near
                elif step:
                    open_[s] = (Interval(start, step, interval.hash_value), below)
                else:
                    open_[s] = (Interval(LEAST_ID, 64, start), below)
                break
            else:
                done[s] = _boundary(interval, interval.start + (1 << interval.bits), below)
            if s in done:
                del open_[s]
    return [done[s] for s in sorted(done)]


def shard_by_bytes(rows: DataFrame, text_hash: str, doc_id: str, size: str, shards: int = 8,
                   tolerance: float = TOLERANCE) -> DataFrame:
    """Add shard (0 to shards - 1) and slot (gapless from 0 in each shard).

    ``text_hash`` is any 64-bit hash column, ``size`` the bytes of a row.
    """
    own = rows.drop("shard", "slot")
    key = own.withColumns({"_hash": F.shiftrightunsigned(F.col(text_hash), 64 - HASH_BITS),
                           "_order_id": F.coalesce(F.col(doc_id), F.lit(LEAST_ID))})
    keys = materialize(key.select(F.col("_hash").alias("hash"), F.col("_order_id").alias("order_id"), F.col(size).alias("size")), "shard-keys")
    bounds = find_boundaries(keys, shards, tolerance)
    shard = F.lit(0)
    for b in bounds:
        shard = shard + b.reached(F.col("_hash"), F.col("_order_id")).cast("int")
    placed = with_global_index(key.withColumn("shard", shard), [F.col("_hash"), F.col("_order_id"), F.col(size)], "_place")
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    return (placed.join(F.broadcast(first), "shard")  # one row a shard
            .withColumn("slot", F.col("_place") - F.col("_first")).drop("_hash", "_order_id", "_place", "_first"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write every shard into a folder of its own, rows in slot order within each file."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
