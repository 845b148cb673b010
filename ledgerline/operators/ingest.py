"""W4 — bronze ingest: a faithful copy of the source plus the load time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ingest_bronze(df: DataFrame, ingested_at: dt.datetime | Column | None = None,
                  column: str = "_ingested_at") -> DataFrame:
    """Copy every source row and column unchanged and stamp the read time.

    Nothing is filtered, cast or deduplicated: bronze row count equals the
    source row count. ``ingested_at`` is an argument (default: the query's
    current timestamp) so tests and re-runs can pin it. The plan is a single
    narrow projection over the scan, no shuffle.
    """
    if ingested_at is None:
        stamp = F.current_timestamp()
    elif isinstance(ingested_at, Column):
        stamp = ingested_at
    else:
        stamp = F.lit(ingested_at).cast("timestamp")
    return df.withColumn(column, stamp)


def ingest_check(source: DataFrame, bronze: DataFrame, name: str) -> DataFrame:
    """One row ``(table_name, source_rows, bronze_rows, same_content)``.

    Each side is read on its own: its rows are counted and hashed over all
    columns of the source (NULLs take part), and the hashes are summed, so a
    lost, repeated or changed row shows whatever the order. One narrow pass
    per side and a global aggregate; nothing is shuffled but partial sums.
    """
    def side(df: DataFrame, is_source: bool) -> DataFrame:
        parts = [e for c in source.columns for e in (F.col(c), F.col(c).isNull())]
        return df.select(F.lit(is_source).alias("s"), F.xxhash64(*parts).cast("decimal(38,0)").alias("h"))

    both = side(source, True).unionByName(side(bronze, False)).agg(
        F.count_if("s").alias("source_rows"), F.count_if(~F.col("s")).alias("bronze_rows"),
        F.sum(F.when(F.col("s"), F.col("h"))).alias("a"), F.sum(F.when(~F.col("s"), F.col("h"))).alias("b"))
    return both.select(F.lit(name).alias("table_name"), "source_rows", "bronze_rows",
                       F.col("a").eqNullSafe(F.col("b")).alias("same_content"))
