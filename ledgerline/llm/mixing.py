"""Mixing sources to target weights: repetition rates and hash-seeded copies.

Sources stand in code-point order, NULL last, and take the weights in turn.
Together they share the whole amount (the words of all documents); a source's
target stops at ``max_rate`` times its own size and the excess goes to the
others by weight, until none is above. A source's rate is target / size; a
document is emitted floor(rate) times, plus once more with probability equal to
the fraction, decided by a hash of its id and the seed, so reruns agree.

Words are counted in one pass over the texts, added up map-side per source, and
only the table of sources (one row each) is ordered and levelled. The level is
found by counting, over that table, the sources above it; each round is one
aggregate of two numbers.

Defined results: NULL and empty texts have size 0 and follow their source's
rate (they add no words); a source without words has target 0 and takes
nothing; NULL sources form one source, the last; a NULL doc_id is drawn as the
empty string; repeated rows get the same copies; ties do not arise (sources are
distinct); an empty table gives an empty result; extra columns pass through
unless their name is one of the new columns, which then replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD_GAP, with_global_index
from ledgerline.sources.tables import materialize

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_GAP.replace("[", "[^"))).cast("long")


@dataclass(frozen=True)
class Level:
    """Every source below its cap gets weight * amount / weights."""

    amount: int
    weights: int


def source_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Give the sources their weights in code-point order, NULL last."""
    placed = with_global_index(sources, [F.col("source").asc_nulls_last()], "place")
    cycle = F.array(*[F.lit(w) for w in weights])
    return placed.withColumn("weight", F.get(cycle, (F.col("place") % len(weights)).cast("int")).cast("long")).drop("place")


def find_level(sources: DataFrame, max_rate: int = MAX_RATE) -> Level:
    """The level at which the targets add up to the whole amount.

    Starts with no source capped and takes off those whose share is above their
    cap until none is; the set of capped sources only grows.
    """
    size, weight = F.col("source_size"), F.col("weight")
    total = sources.agg(F.sum(size).alias("n"), F.sum(weight).alias("w")).first()
    level = Level(total["n"] or 0, total["w"] or 1)
    while True:
        capped = _capped(level, max_rate)
        left = sources.agg(F.sum(F.when(capped, size * max_rate).otherwise(0)).alias("taken"),
                           F.sum(F.when(capped, 0).otherwise(weight)).alias("w")).first()
        found = Level((total["n"] or 0) - (left["taken"] or 0), left["w"] or 0)
        if not found.weights or found == level:
            return level
        level = found


def _capped(level: Level, max_rate: int) -> Column:
    """Exact: cap * weights < weight * amount, in decimals."""
    big = "decimal(38,0)"
    return ((F.col("source_size") * max_rate).cast(big) * F.lit(level.weights).cast("decimal(18,0)")
            < F.col("weight").cast("decimal(18,0)") * F.lit(level.amount).cast("decimal(20,0)"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """source, source_size, target for rows with source and size."""
    sources = materialize(source_weights(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "mix-sources")
    level = find_level(sources, max_rate)
    cap = F.col("source_size") * max_rate
    share = (F.col("weight") * F.lit(level.amount)).cast("double") / F.lit(float(level.weights))
    return sources.select(
        "source", "source_size",
        F.when(_capped(level, max_rate), cap.cast("double")).otherwise(F.least(share, cap.cast("double"))).alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:doc_id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def with_copies(docs: DataFrame, sized: DataFrame | None = None, weights: tuple[int, ...] = WEIGHTS,
                max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """Add size, source_size, target and copies (how often the mix takes the row).

    ``sized`` (source, size of every row) may be given where it is stored already.
    """
    docs = docs.withColumn("size", n_words(F.col("text"))) if sized is None else docs
    targets = source_targets(docs.select("source", "size") if sized is None else sized, weights, max_rate)
    targets = targets.withColumnRenamed("source", "_source")
    rate = F.coalesce(F.least(F.try_divide("target", "source_size"), F.lit(float(max_rate))), F.lit(0.0))
    whole = F.floor(rate)
    extra = (draw(F.col("doc_id"), seed) < rate - whole).cast("long")
    kept = docs.drop("source_size", "target", "copies")
    return (kept.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("copies", whole + extra))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> DataFrame:
    """The mixed corpus: every document as often as the mix takes it, columns unchanged."""
    counted = with_copies(docs.withColumn("_row", F.struct("*")).select("_row", "doc_id", "source", "text"),
                          weights=weights, max_rate=max_rate, seed=seed)
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return counted.select("_row", repeated.alias("_copy")).select("_row.*")


def oracle_sql(weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE, seed: str = SEED) -> str:
    """The same rows in DuckDB; the level by sorting the sources by cap / weight."""
    turns = " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(weights))
    return f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} {turns} END AS weight
  FROM sized GROUP BY source),
ranked AS (
  SELECT *, {max_rate} * source_size AS cap, sum(source_size) OVER () AS total,
         coalesce(sum({max_rate} * source_size) OVER before, 0) AS used,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM src
  WINDOW before AS (ORDER BY {max_rate} * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT (total - used) AS amount, open_weight FROM ranked
  WHERE (total - used) * weight <= cap * open_weight
  ORDER BY cap / weight, source NULLS LAST LIMIT 1),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, (weight * level.amount)::DOUBLE / level.open_weight::DOUBLE) AS target
  FROM ranked, level),
rated AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         CASE WHEN t.source_size = 0 THEN 0 ELSE least(t.target / t.source_size, {max_rate}) END AS rate,
         ('0x' || substr(md5('{seed}:' || coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT / {float(1 << 52)!r} AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM rated
"""
