"""W34 — deterministic hash bucketing and stable sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import hash_bucket as _hash_bucket, mod_bucket


def hash_bucket(df: DataFrame, cols: Sequence[str], salt: str, k: int, name: str = "bucket") -> DataFrame:
    """Add ``pmod(hash(cols, salt), k)``: repeatable per (row key, salt),
    independent across salts; a map-only projection."""
    return df.withColumn(name, _hash_bucket(cols, salt, k))


def stable_sample(df: DataFrame, cols: Sequence[str], salt: str, k: int, keep: int = 0) -> DataFrame:
    """A repeatable 1-in-k sample: rows whose Murmur3 bucket equals ``keep``."""
    return df.filter(_hash_bucket(cols, salt, k) == F.lit(keep))


def mod_sample(df: DataFrame, key: str, k: int, keep: int = 0) -> DataFrame:
    """A repeatable 1-in-k sample on an integral key (``pmod(key, k) = keep``)."""
    return df.filter(mod_bucket(key, k) == F.lit(keep))
