"""Packing by harmonic classes: reciprocal-capacity bins with a fixed piece count.

A sequence of C tokens takes floor(C / l) pieces of length l. Every document is
cut into pieces of C, then of C/2, C/4, ... down to ``least`` (1024, 512, ...,
64 of 2048), and a tail below ``least``; the length of a piece is its class, and
class l fills sequence after sequence with floor(C / l) pieces each. A piece's
place in its class is all that decides its sequence and offset, and it is a
running number in its partition plus the counts of the partitions before it, so
workers fill their bins independently. The pieces left over in the last bin of
each class (fewer than one sequence per class, at most 69 classes) are put
together, longest first, into shared sequences.

Texts are tokenised once; ids are carried as bytes and only their checksum
leaves the task. The pieces are written to the shared folder before they are
numbered, so a lost executor can't renumber them.

Defined results: NULL and empty texts hold the end id only; repeated rows are
packed each; rows are numbered in the order in which partitions hold them; a
document of any length is cut, never cropped; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import BARE_CHUNK
from ledgerline.llm.tokens import GROUP_CHARS, kept_table, pieces_of
from ledgerline.sources.tables import materialize

CAPACITY = 2048
LEAST = 64
END_ID = 1
HELD_CHARS = 8_000_000       # characters whose chunks are looked up at once
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, place long"


def cut(n: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of the pieces of ``n`` tokens, longest first."""
    lengths, rest = [capacity] * (n // capacity), n % capacity
    size = capacity // 2
    while size >= least:
        if rest >= size:
            lengths.append(size)
            rest -= size
        size //= 2
    return lengths + [rest] * (rest > 0)


def tokenised(path: str, capacity: int, least: int, end_id: int):
    """An Arrow function (doc_id, text) -> pieces, numbered by class within the partition."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end = kept_table(path, BARE_CHUNK, ids=True), struct.pack("<I", end_id)
        part, places = TaskContext.get().partitionId(), {}

        def documents():
            for batch in rows:
                texts = batch.column(1)
                for i, doc_id in enumerate(batch.column(0).to_pylist()):
                    yield doc_id, texts[i].as_py() or ""

        def encoded():
            held, owners, size = [], [], 0
            for doc_id, text in documents():
                for piece in pieces_of(text, GROUP_CHARS):
                    if held and size + len(piece) > HELD_CHARS:
                        yield from zip(owners, table.parts(held))
                        held, owners, size = [], [], 0
                    held.append(piece)
                    owners.append((doc_id, False))
                    size += len(piece)
                owners[-1] = (doc_id, True)
            yield from zip(owners, table.parts(held))

        out, ids = [], []
        for (doc_id, last), chunks in encoded():
            ids.extend(chunks)
            if not last:
                continue
            packed = b"".join(ids) + end
            ids, start, n = [], 0, len(packed) // 4
            for length in cut(n, capacity, least):
                place = places.get(length, 0)
                places[length] = place + 1
                crc = zlib.crc32(memoryview(packed)[4 * start:4 * (start + length)])
                out.append((doc_id, start, length, crc, n, part, place))
                start += length
            if len(out) >= 20_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    return batches


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in PIECES.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def shared_bins(left: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(length, nth, bin, offset) for the left-over pieces of every class, longest first into each bin."""
    left, taken, placed, number = dict(left), dict.fromkeys(left, 0), [], 0
    while any(left.values()):
        used = 0
        for length in sorted(left, reverse=True):
            count = min(left[length], (capacity - used) // length)
            placed += [(length, taken[length] + i, number, used + i * length) for i in range(count)]
            left[length] -= count
            taken[length] += count
            used += count * length
        number += 1
    return placed


def _classes(spark: SparkSession, totals: dict[int, int], capacity: int) -> tuple[DataFrame, DataFrame]:
    """Per class its bin size and first sequence, and the places of left-over pieces (both bounded by the classes)."""
    rows, first = [], 0
    for length in sorted(totals, reverse=True):
        each = capacity // length
        rows.append((length, each, totals[length] // each, first))
        first += totals[length] // each
    over = shared_bins({length: totals[length] - full * each for length, each, full, _ in rows}, capacity)
    return (spark.createDataFrame(rows, "length long, each long, full long, first long"),
            spark.createDataFrame([(a, b, first + c, d) for a, b, c, d in over],
                                  "length long, nth long, over_id long, over_offset long"))


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, least: int = LEAST, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    source = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    pieces = materialize(source.mapInArrow(tokenised(path, capacity, least, end_id), PIECES), "pieces")
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    classes, over = _classes(docs.sparkSession, totals, capacity)
    ranked = (pieces.join(starts, ["length", "part"]).join(F.broadcast(classes), "length")
              .withColumn("rank", F.col("ahead") + F.col("place"))
              .withColumn("nth", F.col("rank") - F.col("full") * F.col("each")))
    placed = ranked.join(F.broadcast(over), ["length", "nth"], "left")
    regular = F.col("nth") < 0
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.when(regular, F.col("first") + F.floor(F.col("rank") / F.col("each"))).otherwise(F.col("over_id")).cast("long").alias("sequence_id"),
        F.when(regular, F.col("rank") % F.col("each") * F.col("length")).otherwise(F.col("over_offset")).cast("long").alias("offset"))
