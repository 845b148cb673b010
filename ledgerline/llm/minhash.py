"""MinHash near-dedup: fast similarity sketches, banding, exact verification.

A document's set holds its distinct five-word shingles (A-Z lower-cased). Its
sketch has T coordinates filled by rounds of hashed bin placement: in round i
every shingle is thrown into one bin with a value in [i, i + 1) and a bin keeps
its smallest; T rounds throw into random bins, T more give bin after bin its
own round, so every coordinate is filled even for one shingle, and most
documents end after a round or two. Coordinates agree with probability equal
to the likeness, with the concentration of independent samples.

Bands of R coordinates put documents into buckets. Documents with equal sets are
one member from the start. Links are confirmed on full sets, which are read only
for pairs whose rarest shingles leave a link open (an exact bound). The members
of a bucket are not paired with each other: first all meet the bucket's hub (the
member with the most company in all its buckets), which makes a group of copies
one component in one round. What is left are members of buckets that still hold
two components. They are verified exactly: two of them can link only if they
share one of their rarest shingles, so they meet in blocks of these, hub by hub,
until every block belongs to one component. No pair of a bucket that could join
two components stays unseen.

Defined results: NULL and empty texts and texts without words have an empty set
and are linked with nothing; rows with a NULL doc_id are linked with nothing,
their component_id is NULL and they are kept; repeated rows stand or fall
together; of different texts under one doc_id the set with the smallest digest is
compared, the others link with equal sets only; equal sets link; fewer than five
words are one shingle; very long texts are whole sets; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.jaccard_join import Join, blocks_of, members_of, once
from ledgerline.llm.sets import (C as _C, SetReader, connected, digest_of, first_shingles, mix64, points_of, rarity,  # noqa: F401
                                 with_components, words_of)
from ledgerline.sources.tables import materialize

SHINGLE = 5
BANDS, ROWS = 24, 5          # likeness 0.85 misses all bands with probability under 1e-6
BANDS_80 = 36                # of ROWS coordinates: the same for likeness 0.8
GROUP_SHINGLES = 400_000     # shingles sketched at once by one worker
LINK_PERCENT = 85

_EMPTY = np.uint64(2**64 - 1)


def shingle_set(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words (or of all, if fewer)."""
    from xxhash import xxh64_intdigest
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < SHINGLE:
        return mix64((h * _C[:len(h)]).sum(keepdims=True) + np.uint64(len(h)))
    n = len(h) - SHINGLE + 1
    runs = h[:n] * _C[0]
    for j in range(1, SHINGLE):
        runs += h[j:j + n] * _C[j]
    return np.unique(mix64(runs))


def sketches(sets: list[np.ndarray], t: int = BANDS * ROWS) -> np.ndarray:
    """One row of t filled coordinates for each non-empty set."""
    filled = np.full((len(sets), t), _EMPTY, np.uint64)
    flat = filled.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    for i in range(2 * t):
        if not len(x):
            break
        thrown = mix64(x ^ mix64(np.uint64([i + 1]) * _C[0]))
        value = (thrown >> np.uint64(16)) | (np.uint64(i) << np.uint64(48))
        bins = (thrown & np.uint64(0xFFFF)).astype(np.int64) * t >> 16 if i < t else i - t
        np.minimum.at(flat, owner * t + bins, value)
        open_ = (filled == _EMPTY).any(axis=1)
        if not open_.all():
            still = open_[owner]
            x, owner = x[still], owner[still]
    return filled


def band_keys(filled: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit bucket key per band."""
    cut = filled.reshape(len(filled), bands, rows)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), cut.shape[:2])
    for j in range(rows):
        keys = mix64(keys * _C[1] + cut[:, :, j])
    return keys


def set_of(text: bytes | None) -> np.ndarray:
    """A text's set of five-word shingles."""
    return shingle_set(words_of(text))


def _sketch_batches(batches: Iterator[pa.RecordBatch], counts: np.ndarray, percent: int, bands: int = BANDS, rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    def emit(ids, sets):
        keys = band_keys(sketches([s for s in sets if len(s)], bands * rows), bands, rows)
        full = iter(keys.astype(np.int64, copy=False).tolist())
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(list(map(digest_of, sets)), pa.binary()),
            pa.array([next(full) if len(s) else [] for s in sets], pa.list_(pa.int64())),
            pa.array([first_shingles(s, counts, percent).astype(np.int64, copy=False) for s in sets], pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "digest", "bands", "first"])

    for batch in batches:
        ids, sets, held = [], [], 0
        texts = batch.column(1).cast(pa.binary())
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            sets.append(set_of(texts[i].as_py()))
            ids.append(doc_id)
            held += len(sets[-1])
            if held > GROUP_SHINGLES:
                yield emit(ids, sets)
                ids, sets, held = [], [], 0
        if ids:
            yield emit(ids, sets)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = LINK_PERCENT,
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Sets whose likeness is at least ``percent`` are linked; a pair at that
    likeness misses all bands with probability (1 - (percent / 100) ** rows) ** bands.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = rarity(source, set_of)
    sketched = materialize(source.mapInArrow(
        lambda batches: _sketch_batches(batches, counts, percent, bands, rows),
        "doc_id long, n_shingles long, digest binary, bands array<bigint>, first array<bigint>"), "sketches")
    points, names = points_of(sketched, ["bands", "first"])
    rows_of = with_components(sketched, names, _link(points, SetReader(source, points, set_of, percent)))
    return rows_of.withColumn("kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def _link(points: DataFrame, reader: SetReader) -> DataFrame | None:
    """(node, label) of the points that link with another one; None if none does."""
    thrown = points.select("id", "n", F.explode("bands").alias("key"))
    shared = materialize(thrown.groupBy("key").agg(F.count("*").alias("company")).where("company > 1"), "shared")
    # a point has one row per band at most, so its score is a window over few rows
    company = thrown.join(shared, "key").withColumn("score", F.sum("company").over(Window.partitionBy("id")))
    members = materialize(company.select("key", "id", "n", "score", F.col("id").alias("label")), "members")
    join = Join(reader)
    hubs = members.groupBy("key").agg(F.max_by(F.struct("id", "n"), F.struct("score", -F.col("id"))).alias("h")).select(
        "key", F.col("h.id").alias("pivot"), F.col("h.n").alias("pivot_n"))
    met = members.join(hubs, "key").where("id <> pivot")
    fits = 100 * F.least("n", "pivot_n") >= reader.percent * F.greatest("n", "pivot_n")
    join.distances(once(met.where(fits).select("id", "pivot")))
    still = materialize(join.open(met.select(*members.columns)).select("id").distinct(), "still")
    if still.take(1):
        rest = points.join(still, "id", "left_semi")
        join.finish(join.open(members_of(blocks_of(rest))))
    return join.labels
