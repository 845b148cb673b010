"""Bucket boundaries measured from the rows, for keys too hot for one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, TimestampNTZType, TimestampType

from ledgerline.sources.tables import materialize

ACCURACY = 10_000       # of the approximate quantiles: ranks are off by 1 / ACCURACY at most


@dataclass(frozen=True)
class Measured:
    """``split_by=Measured()``: a key with more than 1 / ``parts`` of all rows is cut at quantiles of its own rows."""

    parts: int = 32


def _ranked(kind: DataType) -> bool:
    return isinstance(kind, (NumericType, DateType, TimestampType, TimestampNTZType))


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str = "__r_") -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[f"{prefix}{c}"]) for c in cols])


def _renamed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: f"__r_{c}" for c in cols})


def measured_buckets(df: DataFrame, keys: Sequence[str], order: Sequence[str], parts: int = 32,
                     name: str = "__bucket") -> DataFrame:
    """Add a bucket that never decreases in the order ``order`` (first column NULL first, the others NULL last).

    Keys with more than 1 / ``parts`` of all rows (fewer than ``parts`` keys, so
    their boundaries are broadcast) get boundaries at approximate quantiles of
    their first order column: ranks, not calendar periods. A boundary value is a
    bucket of its own, between two open ranges; one that still holds too many
    rows (a single timestamp of a third of all rows) is cut by the next order
    column, and rows that agree in all of them, whose order is not defined, by a
    hash. Quantiles and counts are partially aggregated, so no hot key is
    gathered to measure it. All other keys are one bucket.
    """
    keys, total = list(keys), df.count()
    most = max(1, -(-total // parts))
    fractions = [i / parts for i in range(1, parts)]
    out, cells = df, list(keys)
    hot = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > most).drop("__n"), "hot-keys")
    depth = 0
    for i, col in enumerate(order):
        if not _ranked(df.schema[col].dataType) or not hot.take(1):
            break
        depth, level = i + 1, f"__b{i}"
        r = _renamed(hot, cells)
        inside = out.join(F.broadcast(r), _same(out, r, cells), "left_semi")
        bounds = materialize(inside.groupBy(*cells).agg(F.coalesce(F.array_sort(F.array_distinct(
            F.percentile_approx(col, fractions, ACCURACY))), F.array().cast(f"array<{df.schema[col].dataType.simpleString()}>")).alias("__bounds")), "bounds")
        r = _renamed(bounds, cells)
        joined = out.join(F.broadcast(r), _same(out, r, cells), "left").drop(*[f"__r_{c}" for c in cells])
        below = F.size(F.filter("__bounds", lambda b: b < F.col(col)))
        at = F.array_contains("__bounds", F.col(col)).cast("int")
        nulls = F.lit(-1) if i == 0 else F.lit(2 * parts + 1)     # odd, like every bucket of one value
        out = joined.withColumn(level, F.when(F.col("__bounds").isNull(), F.lit(0)).when(F.col(col).isNull(), nulls)
                                .otherwise(2 * below + at)).drop("__bounds")
        cells = [*cells, level]
        hot = materialize(out.where(F.col(level) % 2 != 0).groupBy(*cells).agg(F.count(F.lit(1)).alias("__n"))
                          .where(F.col("__n") > most).drop("__n"), "hot-values")
    levels = [f"__b{i}" for i in range(depth)]
    if depth == len(order) and hot.take(1):
        r = _renamed(hot.withColumn("__hot", F.lit(True)), cells)
        out = out.join(F.broadcast(r), _same(out, r, cells), "left").drop(*[f"__r_{c}" for c in cells])
        out = out.withColumn("__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*df.columns), F.lit(parts))).otherwise(F.lit(0))).drop("__hot")
        levels.append("__salt")
    bucket = F.struct(*levels) if levels else F.lit(0)
    return out.withColumn(name, bucket).drop(*levels)
