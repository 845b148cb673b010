"""W3, W9, W10, W23 — referential integrity, quarantine and row conservation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import first_failing


def _keys(on: Sequence[str] | str) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def fk_profile(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str | None = None,
               name: str = "fk") -> DataFrame:
    """Orphan counts of one foreign key, split into NULL key vs unknown key.

    A ``left_anti`` join keeps child rows without a parent (a NULL key never
    matches, so it is an orphan too, as in ``LEFT JOIN ... IS NULL``).
    Catalyst does not rewrite the LEFT JOIN + IS NULL form into an anti join,
    so it is written as one. Output: one row
    ``(check_name, orphans, null_key, unknown_key)``.
    """
    parent_key = parent_key or child_key
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    orphans = child.select(F.col(child_key).alias("__ck")).join(
        p, F.col("__ck") == F.col("__pk"), "left_anti")
    return orphans.agg(
        F.lit(name).alias("check_name"),
        F.count(F.lit(1)).alias("orphans"),
        F.count_if(F.col("__ck").isNull()).alias("null_key"),
        F.count_if(F.col("__ck").isNotNull()).alias("unknown_key"),
    )


def split_orphans(child: DataFrame, parent: DataFrame, on: Sequence[str] | str, reason: str,
                  at: Column | None = None, reason_col: str = "quarantine_reason",
                  at_col: str = "quarantined_at",
                  orphan_cols: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Split child rows by whether their key resolves in ``parent``.

    Returns ``(ok, orphans)``: ``ok`` is the inner join (child + parent
    columns), ``orphans`` the ``left_anti`` rows stamped with a fixed reason
    and time. Both are checked against the same (cleaned) parent, so a row
    lands in exactly one side. The parent must be unique on ``on``.
    """
    keys = _keys(on)
    ok = child.join(parent, on=keys, how="inner")
    orphans = child.join(parent.select(*keys), on=keys, how="left_anti")
    if orphan_cols:
        orphans = orphans.select(*orphan_cols)
    orphans = orphans.withColumn(reason_col, F.lit(reason))
    orphans = orphans.withColumn(at_col, at if at is not None else F.current_timestamp())
    return ok, orphans


def tag_first_failing(df: DataFrame, rules: Sequence[tuple[str, Column]],
                      reason_col: str = "quarantine_reason") -> DataFrame:
    """Add the first failing rule's name (NULL = valid) to every row."""
    return df.withColumn(reason_col, first_failing(rules))


def split_tagged(tagged: DataFrame, keep: Sequence[str], valid_cols: Sequence[str | Column] | None = None,
                 reason_col: str = "quarantine_reason", at: Column | None = None,
                 at_col: str = "quarantined_at") -> tuple[DataFrame, DataFrame]:
    """Split a tagged frame into ``(valid, rejected)`` by its reason column."""
    valid = tagged.filter(F.col(reason_col).isNull()).drop(reason_col)
    if valid_cols is not None:
        valid = valid.select(*valid_cols)
    rej_cols = [F.col(c) for c in keep] + [F.col(reason_col)]
    if at is not None:
        rej_cols.append(at.alias(at_col))
    return valid, tagged.filter(F.col(reason_col).isNotNull()).select(*rej_cols)


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]],
               keep: Sequence[str] | None = None, valid_cols: Sequence[str | Column] | None = None,
               reason_col: str = "quarantine_reason", at: Column | None = None,
               at_col: str = "quarantined_at") -> tuple[DataFrame, DataFrame]:
    """Rule-cascade quarantine.

    ``rules`` is an ordered list of ``(reason, ok_predicate)``. Each row gets
    the *first* reason whose predicate is not TRUE (NULL is a failure), or
    NULL when it passes all. ``valid`` = rows with no reason, ``rejected`` =
    the rest with ``keep`` columns + reason (+ time). One evaluation decides
    both sides, so ``valid + rejected = input`` by construction; the star
    join feeding it is written once (left joins) instead of once per side.
    """
    tagged = tag_first_failing(df, rules, reason_col)
    cols = list(keep) if keep is not None else list(df.columns)
    return split_tagged(tagged, cols, valid_cols, reason_col, at, at_col)


def quarantine_summary(rejected: DataFrame, reason_col: str = "quarantine_reason",
                       amount_col: str | None = None, count_name: str = "n_rows",
                       amount_name: str = "amount_retained") -> DataFrame:
    """Per-reason count and retained amount of a quarantine table."""
    aggs = [F.count(F.lit(1)).alias(count_name)]
    if amount_col:
        aggs.append(F.round(F.sum(amount_col), 2).alias(amount_name))
    return rejected.groupBy(reason_col).agg(*aggs)


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row with ``count(*)`` of every frame, as columns named by the keys.

    Each frame contributes a one-row partial count; the partials are stacked
    and folded by a global aggregate over a handful of rows, so no join is
    needed to put the counters side by side.
    """
    parts = None
    for name, df in frames.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy().agg(*[
        F.sum(F.when(F.col("name") == name, F.col("n"))).cast("long").alias(name) for name in frames
    ])


def conservation_tagged(total: DataFrame, tagged: DataFrame, reason_col: str = "quarantine_reason") -> DataFrame:
    """``total``, ``valid``, ``rejected``, ``difference`` with one scan of the checked rows.

    Both sides are two conditional counts of the frame that holds them together.
    """
    parts = (total.agg(F.count(F.lit(1)).alias("total")).withColumns({"valid": F.lit(0), "rejected": F.lit(0)})
             .unionByName(tagged.agg(F.count_if(F.col(reason_col).isNull()).alias("valid"), F.count(reason_col).alias("rejected"))
                          .withColumn("total", F.lit(0))))
    sums = parts.groupBy().agg(*[F.sum(c).cast("long").alias(c) for c in ("total", "valid", "rejected")])
    return sums.withColumn("difference", F.col("total") - F.col("valid") - F.col("rejected"))


def conservation(total: DataFrame, parts: Mapping[str, DataFrame], total_name: str = "total") -> DataFrame:
    """``total = sum(parts)`` as one row of counters plus the difference.

    ``difference`` must be 0 (for example deduped claims = valid + rejected).
    """
    counts = row_counts({total_name: total, **parts})
    diff = F.col(total_name) - sum((F.col(p) for p in parts), F.lit(0))
    return counts.withColumn("difference", diff.cast("long"))


def assert_conserved(total: DataFrame, parts: Mapping[str, DataFrame]) -> None:
    """Raise when rows were lost or invented (runs one small aggregate)."""
    row = conservation(total, parts).first()
    if row["difference"] != 0:
        raise AssertionError(f"row conservation failed: {row.asDict()}")
