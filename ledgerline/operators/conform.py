"""W5-W8 — typed conform, latest-version dedup, version inspector, conformed dimension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import decode


def _order_cols(version: Sequence[str] | str, tiebreak: Sequence[str]) -> list[Column]:
    versions = [version] if isinstance(version, str) else list(version)
    return ([F.col(v).desc_nulls_last() for v in versions]
            + [F.col(t).asc_nulls_last() for t in tiebreak])


def conform(df: DataFrame, types: Mapping[str, str], deleted_flag: str | None = None,
            deleted_value: int = 0, keep: Sequence[str] = (),
            rename: Mapping[str, str] | None = None) -> DataFrame:
    """Logical-delete filter then the typing layer.

    * ``types`` maps source column -> Spark SQL type; the output keeps the
      column name unless ``rename`` gives a new one.
    * the delete filter compares the *raw* column (``flag = 0``) so Parquet
      receives it as a pushed filter; a ``cast(flag as int) = 0`` would only
      push ``IsNotNull``.
    * ``keep`` lists columns carried untyped (for example the load version
      that a following dedup orders by).
    """
    rename = dict(rename or {})
    if deleted_flag is not None:
        df = df.filter(F.col(deleted_flag) == F.lit(deleted_value))
    cols = [F.col(c).cast(t).alias(rename.get(c, c)) for c, t in types.items()]
    cols += [F.col(c) for c in keep if c not in types]
    return df.select(*cols)


def dedup_latest(df: DataFrame, keys: Sequence[str], version: Sequence[str] | str,
                 tiebreak: Sequence[str] = (), deleted_flag: str | None = None,
                 deleted_value: int = 0, deleted: str = "before_dedup",
                 drop: Sequence[str] = ()) -> DataFrame:
    """One row per key, the newest version wins.

    ``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY version DESC, tiebreak) = 1``.
    Spark plans this as a partial ``WindowGroupLimit`` before the shuffle, so
    every map task already reduces a hot key to one row and only one row per
    key and map partition crosses the network.

    ``deleted`` decides where the logical-delete filter runs:
    ``"before_dedup"`` (reference order: an older version survives when the
    newest one is a tombstone) or ``"after_dedup"`` (a tombstone deletes the
    key). ``tiebreak`` must make the order total, otherwise the chosen row
    depends on partitioning.
    """
    if deleted not in ("before_dedup", "after_dedup"):
        raise ValueError("deleted must be 'before_dedup' or 'after_dedup'")
    if deleted_flag is not None and deleted == "before_dedup":
        df = df.filter(F.col(deleted_flag) == F.lit(deleted_value))
    w = Window.partitionBy(*keys).orderBy(*_order_cols(version, tiebreak))
    out = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")
    if deleted_flag is not None and deleted == "after_dedup":
        out = out.filter(F.col(deleted_flag) == F.lit(deleted_value))
    return out.drop(*drop) if drop else out


def multi_version(df: DataFrame, keys: Sequence[str], min_count: int = 2,
                  count_col: str = "n_versions") -> DataFrame:
    """Every row of the keys that occur at least ``min_count`` times.

    Counted with a partially aggregated ``groupBy`` and joined back on the
    keys instead of ``COUNT(*) OVER (PARTITION BY keys)``: the count is
    combined map-side, and AQE can split a skewed key in the join, while a
    window would put a whole hot key into one task.
    """
    counts = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .filter(F.col(count_col) >= min_count))
    return df.join(counts, on=list(keys), how="inner")


def conform_dimension(child: DataFrame, parent: DataFrame, on: Sequence[str] | str,
                      decode_cols: Mapping[str, tuple[str, Mapping[object, str], str | None]] | None = None,
                      how: str = "inner", select: Sequence[str | Column] | None = None) -> DataFrame:
    """Join an already conformed child to its conformed parent.

    ``decode_cols`` adds label columns ``{out: (code_col, {code: label}, default)}``
    once, here, instead of in every report. The parent must be unique on
    ``on`` (run :func:`dedup_latest` first) or child rows would multiply.
    Spark picks broadcast when the parent's estimated size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and a sort-merge join beyond it;
    AQE re-decides from the real shuffle size at run time.
    """
    on = [on] if isinstance(on, str) else list(on)
    out = child.join(parent, on=on, how=how)
    for name, (code, mapping, default) in (decode_cols or {}).items():
        out = out.withColumn(name, decode(code, mapping, default))
    return out.select(*select) if select else out
