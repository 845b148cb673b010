"""W2, W26-W33 — symptom trend and price/volume variance attribution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import safe_ratio
from ledgerline.operators.asof import asof_join


def _d(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def trend(df: DataFrame, period: str | Column, measures: Mapping[str, Column]) -> DataFrame:
    """Per-period counters (claims, cost, flagged entities ...)."""
    return df.groupBy(period).agg(*[c.alias(n) for n, c in measures.items()])


def decompose_price_volume(gold: DataFrame, period: str = "month", count: str = "n_claims",
                           reference: str = "ref_total", cost: str = "cost_total",
                           unit: float = 1_000_000.0) -> DataFrame:
    """Volume (reference value) vs price (cost over reference) per period.

    Reference value grows only with volume and mix, cost also with price;
    their ratio isolates price. Ratio of sums, never mean of ratios.
    """
    return gold.groupBy(period).agg(
        F.sum(count).alias("n_claims"),
        safe_ratio(F.sum(reference), F.lit(unit), 2).alias("reference_millions"),
        safe_ratio(F.sum(cost), F.lit(unit), 2).alias("cost_millions"),
        safe_ratio(F.sum(cost), F.sum(reference), 4).alias("cost_index"),
    )


def _period_sum(col: str, cond: Column) -> Column:
    # No ELSE: an empty period gives NULL, not 0 (the ratio is then NULL).
    return F.sum(F.when(cond, F.col(col)))


def index_variation(gold: DataFrame, segment: Sequence[str] | str, base: Column, recent: Column,
                    cost: str = "cost_total", reference: str = "ref_total") -> DataFrame:
    """Base vs recent cost index and % change per segment, one pass.

    ``base``/``recent`` are period predicates (e.g. ``month <= 200012``); rows of
    neither period are not read (pruned, where gold has a folder per month), so
    a segment without rows in both has no result row.
    """
    seg = [segment] if isinstance(segment, str) else list(segment)
    agg = gold.filter(base | recent).groupBy(*seg).agg(
        _period_sum(cost, base).alias("__cb"), _period_sum(reference, base).alias("__rb"),
        _period_sum(cost, recent).alias("__cr"), _period_sum(reference, recent).alias("__rr"))
    ib = _d("__cb") / F.nullif(_d("__rb"), F.lit(0.0))
    ir = _d("__cr") / F.nullif(_d("__rr"), F.lit(0.0))
    return agg.select(*seg, F.round(ib, 4).alias("idx_base"), F.round(ir, 4).alias("idx_recent"),
                      F.round(F.lit(100.0) * (ir / F.nullif(ib, F.lit(0.0)) - F.lit(1.0)), 1).alias("variation_pct"))


def excess_by_entity(gold: DataFrame, entity: str, attrs: Sequence[str], base: Column, recent: Column,
                     flag: str = "anomaly_flag", cost: str = "cost_total", reference: str = "ref_total",
                     only_flagged: bool = True) -> DataFrame:
    """Excess cost = recent cost - recent reference x own base-period index.

    The base index is per entity; recent totals are per entity and
    ``attrs`` (as the reference groups them). One scan: both periods are
    conditional aggregates of one group-by on (entity, attrs), and the
    entity's base index is a window sum over its few aggregated rows (one
    per attribute combination, never the raw rows). Rows qualify as the
    inner join of the two period aggregates would: the (entity, attrs)
    group has recent rows and the entity has base rows; NULL entities
    never match.
    """
    agg = gold.filter(F.col(entity).isNotNull() & (base | recent)).groupBy(entity, *attrs).agg(
        F.sum(F.when(base, F.col(cost))).alias("__cb"), F.sum(F.when(base, F.col(reference))).alias("__rb"),
        F.count_if(base).alias("__nb"),
        F.sum(F.when(recent, F.col(cost))).alias("__c"), F.sum(F.when(recent, F.col(reference))).alias("__r"),
        F.max(F.when(recent, F.col(flag))).alias("flagged"), F.count_if(recent).alias("__nr"))
    w = Window.partitionBy(entity)
    agg = agg.withColumns({"__cb_e": F.sum("__cb").over(w), "__rb_e": F.sum("__rb").over(w),
                           "__nb_e": F.sum("__nb").over(w)})
    out = agg.filter((F.col("__nr") > 0) & (F.col("__nb_e") > 0)).withColumn(
        "__ib", _d("__cb_e") / F.nullif(_d("__rb_e"), F.lit(0.0)))
    if only_flagged:
        out = out.filter(F.col("flagged") == 1)
    return out.select(
        entity, *attrs, "flagged",
        F.round(F.col("__ib"), 3).alias("idx_base"),
        F.round(_d("__c") / F.nullif(_d("__r"), F.lit(0.0)), 3).alias("idx_recent"),
        F.round(_d("__c") - _d("__r") * F.col("__ib"), 2).alias("excess_cost"))


def flagged_entities(gold: DataFrame, entity: str, flag: str = "anomaly_flag") -> DataFrame:
    """Distinct entities flagged at least once (the default exclusion set)."""
    return gold.filter(F.col(flag) == 1).select(entity).distinct()


def excess_by_segment(gold: DataFrame, segment: Sequence[str] | str, base: Column, recent: Column,
                      exclude: DataFrame | None = None, entity: str | None = None,
                      cost: str = "cost_total", reference: str = "ref_total") -> DataFrame:
    """Segment-level excess after removing already explained entities.

    ``exclude`` is an explicit entity set (``left_anti`` on ``entity``), so
    money attributed to a concentrated cause is not counted again here. Rows of
    neither period are not read.
    """
    seg = [segment] if isinstance(segment, str) else list(segment)
    src = gold.filter(base | recent)
    if exclude is not None:
        src = src.join(exclude, on=entity, how="left_anti")
    agg = src.groupBy(*seg).agg(
        _period_sum(cost, base).alias("__cb"), _period_sum(reference, base).alias("__rb"),
        _period_sum(cost, recent).alias("__cr"), _period_sum(reference, recent).alias("__rr"))
    ib = _d("__cb") / F.nullif(_d("__rb"), F.lit(0.0))
    return agg.select(*seg, F.round(ib, 4).alias("idx_base"),
                      F.round(_d("__cr") / F.nullif(_d("__rr"), F.lit(0.0)), 4).alias("idx_recent"),
                      F.round(_d("__cr") - _d("__rr") * ib, 2).alias("excess_cost"))


def drill_down(gold: DataFrame, by: Sequence[str], where: Column | None = None,
               dim: DataFrame | None = None, on: str | None = None, dim_cols: Sequence[str] = (),
               entity: str = "provider_id", cost: str = "cost_total",
               reference: str = "ref_total") -> DataFrame:
    """Index and distinct entities per ``by`` inside a filtered slice,
    optionally enriched with current attributes from a dimension."""
    src = gold.filter(where) if where is not None else gold
    if dim is not None:
        src = src.join(dim.select(on, *dim_cols), on=on, how="inner")
    return src.groupBy(*by, *dim_cols).agg(
        F.count_distinct(entity).alias("n_entities"),
        safe_ratio(F.sum(cost), F.sum(reference), 4).alias("cost_index"))


def post_event_activity(gold: DataFrame, period: str = "month",
                        count_col: str = "n_post_termination") -> DataFrame:
    """Claims served after the provider left, per period (stays in the fact)."""
    return gold.groupBy(period).agg(F.sum(count_col).alias("n_after_termination"))


def post_event_difference(fact: DataFrame, intervals: DataFrame, key: str, at: str, ended: str, planted: str,
                          period: str = "month", split_by=None) -> DataFrame:
    """W31 derived: facts after the entity's end, told by its history, beside a flag that the rows carry.

    An entity's end is the first ``ended`` date that its validity intervals (W12)
    know; it splits time into the span up to that day and the one after it, and
    the as-of scan tells in which a fact lies. One row per period:
    ``n_derived``, ``n_flagged``, ``n_only_derived`` and the facts that only the
    flag marks, by reason: ``n_no_history`` (entity without interval),
    ``n_no_end`` (its intervals know no end), ``n_before`` (dated up to the end).
    """
    ends = intervals.groupBy(key).agg(F.date_add(F.min(ended), 1).alias("__next"))
    low, high = F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date")
    lasting = ends.select(key, low.alias("__from"), F.coalesce("__next", high).alias("__to"),
                          F.when(F.col("__next").isNull(), F.lit("no_end")).otherwise(F.lit("before")).alias("__state"))
    after = ends.where("__next IS NOT NULL").select(key, F.col("__next").alias("__from"), high.alias("__to"), F.lit("after").alias("__state"))
    placed = asof_join(fact.select(key, at, period, planted), lasting.unionByName(after), key, at, cols=["__state"],
                       start="__from", end="__to", how="left", split_by=split_by)
    state = F.coalesce("__state", F.lit("no_history"))
    flagged = F.coalesce(F.col(planted) == 1, F.lit(False))
    return placed.groupBy(period).agg(
        F.count_if(state == "after").alias("n_derived"), F.count_if(flagged).alias("n_flagged"),
        F.count_if((state == "after") & ~flagged).alias("n_only_derived"),
        *[F.count_if(flagged & (state == s)).alias(f"n_{s}") for s in ("no_history", "no_end", "before")])


def top_outliers(gold: DataFrame, k: int, order_by: str = "peer_index", tiebreak: Sequence[str] = (),
                 where: Column | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """The k rows with the highest ``order_by`` (TakeOrderedAndProject).

    ``tiebreak`` makes the cut deterministic when values tie.
    """
    src = gold.filter(where) if where is not None else gold
    if cols:
        src = src.select(*dict.fromkeys([*cols, order_by, *tiebreak]))
    ordered = src.orderBy(F.col(order_by).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tiebreak])
    out = ordered.limit(k)
    return out.select(*cols) if cols else out


def segment_cost(fact: DataFrame, dim: DataFrame, on: str, by: Sequence[str], amount: str = "paid",
                 member: str = "member_id", k: int | None = None) -> DataFrame:
    """Cost per segment at fact grain (the gold grain lacks the segment).

    Ranked by cost per distinct member; ``k`` keeps the top k segments.
    When the join key is the member itself (``dim`` unique on it), the fact
    is first reduced to one row per member by a partially aggregated
    group-by, so the join moves members instead of claims and the distinct
    member count becomes a plain count (exact sums, same result).
    """
    if member == on:
        per_member = fact.groupBy(on).agg(F.count(F.lit(1)).alias("__n"), F.sum(amount).alias("__amt"))
        joined = per_member.join(dim.select(on, *by), on=on, how="inner")
        agg = joined.groupBy(*by).agg(
            F.sum("__n").alias("n_claims"),
            safe_ratio(F.sum("__amt"), F.lit(1000.0), 2).alias("cost_thousands"),
            safe_ratio(F.sum("__amt"), F.count(F.lit(1)), 2).alias("cost_per_member"))
    else:
        joined = fact.select(on, amount, member).join(dim.select(on, *by), on=on, how="inner")
        agg = joined.groupBy(*by).agg(
            F.count(F.lit(1)).alias("n_claims"),
            safe_ratio(F.sum(amount), F.lit(1000.0), 2).alias("cost_thousands"),
            safe_ratio(F.sum(amount), F.count_distinct(member), 2).alias("cost_per_member"))
    if k is None:
        return agg
    return agg.orderBy(F.col("cost_per_member").desc_nulls_last(), *[F.col(b).asc_nulls_last() for b in by]).limit(k)
