"""W16-W19 — grain roll-up, derived ratios, surrogate key, peer index."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import decimal_ratio, safe_ratio


def rollup_grain(df: DataFrame, grain: Sequence[str | Column], measures: Mapping[str, Column]) -> DataFrame:
    """Aggregate to a declared grain.

    Plain sums/counts are combined map-side (partial aggregation) before
    the shuffle on the grain; an exact ``count_distinct`` among them is
    planned by Spark as a two-phase distinct aggregate. Never replaced by an
    approximate count.
    """
    return df.groupBy(*grain).agg(*[c.alias(n) for n, c in measures.items()])


def ratio_measures(df: DataFrame, spec: Mapping[str, tuple]) -> DataFrame:
    """``{name: (numerator, denominator, scale[, factor[, "decimal"]])}`` ratios.

    Zero-safe (``NULLIF(den, 0)``): an empty or zero denominator yields
    NULL, never an ANSI division error. Computed in DOUBLE, or in exact
    DECIMAL when the fifth element is ``"decimal"`` (money over a count).
    """
    cols = {}
    for name, s in spec.items():
        num, den, scale = s[0], s[1], s[2]
        factor = s[3] if len(s) > 3 else None
        if len(s) > 4 and s[4] == "decimal":
            cols[name] = decimal_ratio(num, den, scale)
        else:
            cols[name] = safe_ratio(num, den, scale, factor)
    return df.withColumns(cols)


def surrogate_key(df: DataFrame, cols: Sequence[str], name: str = "sk") -> DataFrame:
    """``xxhash64`` over the stringified grain columns."""
    return df.withColumn(name, F.xxhash64(*[F.col(c).cast("string") for c in cols]))


def surrogate_key_pair(df: DataFrame, cols: Sequence[str], names: Sequence[str] = ("sk_hi", "sk_lo")) -> DataFrame:
    """A 128-bit key in two longs, the halves of an MD5 over the grain columns.

    64 bits collide by chance from some billions of grains on; 128 bits don't.
    Every value has its length in front and NULL is told from an empty string, so
    no two grains give the same text.
    """
    text = F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for c in cols
                      for v in [F.col(c).cast("string")]])
    digest = F.md5(F.encode(text, "utf-8"))
    # a negative base gives the signed number of the 64 bits
    halves = [F.conv(F.substring(digest, 1 + 16 * i, 16), 16, -10).cast("long") for i in range(2)]
    return df.withColumns(dict(zip(names, halves)))


def key_integrity(df: DataFrame, key: str | Sequence[str], grain: Sequence[str]) -> DataFrame:
    """One row ``(n_rows, n_grains, n_keys, n_duplicate_grains, n_collisions)``.

    A key on two rows is a duplicate grain (the data are at fault) or a collision
    (two grains, the key is): grains are counted first, then the grains of each
    key. Two partially aggregated group-bys; no row meets another.
    """
    keys = [key] if isinstance(key, str) else list(key)
    grains = df.groupBy(*keys, *[c for c in grain if c not in keys]).agg(F.count(F.lit(1)).alias("__n"))
    per_key = grains.groupBy(*keys).agg(F.sum("__n").alias("__rows"), F.count(F.lit(1)).alias("__grains"), F.count_if(F.col("__n") > 1).alias("__twice"))
    z = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return per_key.agg(z(F.sum("__rows")).alias("n_rows"), z(F.sum("__grains")).alias("n_grains"), F.count(F.lit(1)).alias("n_keys"),
                       z(F.sum("__twice")).alias("n_duplicate_grains"), F.count_if(F.col("__grains") > 1).alias("n_collisions"))


def assert_key(df: DataFrame, key: str | Sequence[str], grain: Sequence[str]) -> None:
    """Raise with the cause: rows of one grain more than once, or grains that share a key."""
    row = key_integrity(df, key, grain).first()
    if row["n_collisions"]:
        raise AssertionError(f"key collision, take a longer key: {row.asDict()}")
    if row["n_duplicate_grains"]:
        raise AssertionError(f"grain repeated: {row.asDict()}")


def key_uniqueness(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row ``(n_rows, n_distinct, n_duplicates)``; duplicates must be 0."""
    keys = [key] if isinstance(key, str) else list(key)
    distinct = F.count_distinct(*[F.col(k) for k in keys])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_distinct"),
                  (F.count(F.lit(1)) - distinct).alias("n_duplicates"))


def assert_unique(df: DataFrame, key: str | Sequence[str]) -> None:
    row = key_uniqueness(df, key).first()
    if row["n_duplicates"]:
        raise AssertionError(f"duplicate keys: {row.asDict()}")


def peer_index(df: DataFrame, measure: str, peers: Sequence[str], threshold: float = 1.5,
               volume: str | None = None, min_volume: int = 10, index_col: str = "peer_index",
               flag_col: str = "anomaly_flag", scale: int = 4, mean_col: str | None = None) -> DataFrame:
    """Measure divided by the mean of its peer group (self included).

    ``index = round(measure / NULLIF(avg(measure) over peers, 0), scale)``;
    ``flag = 1`` when the *unrounded* ratio is ``>= threshold`` and
    ``volume >= min_volume``.

    The peer mean comes from a partially aggregated ``groupBy(peers)`` that
    is joined back (null-safe, so a NULL peer value forms its own group like
    a window partition would); a huge peer group is never funnelled into one
    task the way ``AVG() OVER (PARTITION BY ...)`` would.

    The means have one row per peer group; the planner broadcasts them when
    their measured bytes are under its threshold and otherwise shuffles both
    sides, a join that AQE can still split on a hot group.
    """
    m = F.col(measure).cast("double")
    means = df.groupBy(*peers).agg(F.avg(m).alias("__peer_mean"))
    means = means.select(*[F.col(p).alias(f"__p_{p}") for p in peers], "__peer_mean")
    cond = None
    for p in peers:
        c = df[p].eqNullSafe(means[f"__p_{p}"])
        cond = c if cond is None else cond & c
    joined = df.join(means, cond, "left")
    ratio = F.col(measure).cast("double") / F.nullif(F.col("__peer_mean"), F.lit(0.0))
    is_high = ratio >= F.lit(threshold)
    if volume is not None:
        is_high = is_high & (F.col(volume) >= F.lit(min_volume))
    out = joined.withColumns({
        index_col: F.round(ratio, scale),
        flag_col: F.when(is_high, F.lit(1)).otherwise(F.lit(0)),
    })
    drop = [f"__p_{p}" for p in peers]
    if mean_col:
        out = out.withColumnRenamed("__peer_mean", mean_col)
    else:
        drop.append("__peer_mean")
    return out.drop(*drop)
