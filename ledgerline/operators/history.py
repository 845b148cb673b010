"""W11-W14 — event timeline, SCD type 2 intervals, forward fill and their checks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import any_not_null
from ledgerline.operators.buckets import Measured, measured_buckets


def _lit_date(value: dt.date | str | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def event_timeline(audit: DataFrame, current: DataFrame, ts: str, columns: Sequence[str],
                   any_of: Sequence[str], as_of: dt.date | str | Column,
                   deleted_flag: str | None = None, deleted_value: int = 0) -> DataFrame:
    """Audit history plus the current state stamped at ``as_of``.

    History keeps events that are not reversed **and** carry at least one
    attribute: ``deleted = 0 AND (a IS NOT NULL OR b IS NOT NULL ...)`` with
    the OR block grouped as one Column, so the delete filter cannot be
    bypassed. ``as_of`` is an argument (not ``current_date()``) so the output
    does not change from one day to the next. Narrow union, no shuffle.
    """
    hist = audit
    if deleted_flag is not None:
        hist = hist.filter((F.col(deleted_flag) == F.lit(deleted_value)) & any_not_null(any_of))
    else:
        hist = hist.filter(any_not_null(any_of))
    hist = hist.select(*columns, ts)
    cur = current.select(*columns).withColumn(ts, _lit_date(as_of))
    return hist.unionByName(cur)


def _window(key: Sequence[str] | str, ts: str, tiebreak: Sequence[str]) -> Window:
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(F.col(ts).asc(), *[F.col(t).asc_nulls_last() for t in tiebreak])


def _bucketed_scan(df: DataFrame, keys: list[str], ts: str, tiebreak: Sequence[str], cols: Sequence[str],
                   split_by: Column | Measured, prev_col: str | None = None, next_col: str | None = None,
                   lags: Mapping[str, str] | None = None) -> DataFrame:
    """Forward fill (and previous / next timestamp) for keys too hot for one task.

    ``split_by`` must be a non-decreasing function of ``ts`` (e.g. its day), or
    :class:`Measured` for boundaries taken from the rows of the hot keys.
    Phase 1 reduces every (key, bucket) to one summary row (last non-null
    value of each column, first and last timestamp) with a partially
    aggregated group-by: map tasks combine before the shuffle. Phase 2
    carries the summaries across the buckets of a key with a window over
    the *summaries* (one row per bucket). Phase 3 unions, per (key, bucket),
    a head row holding the carried values and the previous bucket's last
    timestamp (and a tail row holding the next bucket's first timestamp)
    into the rows, scans each (key, bucket) on its own and drops the
    synthetic rows. ``lags`` maps output names to columns whose previous-row
    value is wanted (the head row holds the previous bucket's last value).
    Results equal the single-window scan, with one shuffle
    of the rows and no join, while a key with a third of all rows is spread
    over its buckets. NULL keys and buckets group like window partitions.
    """
    lags = dict(lags or {})
    if prev_col:
        lags[prev_col] = ts
    lag_src = [c for c in dict.fromkeys(lags.values()) if c != ts]
    if set(lag_src) & set(cols):
        raise ValueError("a column cannot be both filled and lagged in one bucketed scan")
    bucketed = measured_buckets(df, keys, [ts, *tiebreak], split_by.parts) if isinstance(split_by, Measured) else df.withColumn("__bucket", split_by)
    x = bucketed.withColumn("__flag", F.lit(1))
    # same order as the window below: ts ascending (NULL first), tiebreaks NULL last
    ordkey = F.struct(F.col(ts), *[p for t in tiebreak for p in (F.col(t).isNull(), F.col(t))])
    summary = x.groupBy(*keys, "__bucket").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordkey)).alias(f"__last_{c}") for c in cols],
        *[F.max_by(F.col(c), ordkey).alias(f"__lastrow_{c}") for c in lag_src],
        F.max(F.col(ts)).alias("__max_ts"), F.min(F.col(ts)).alias("__min_ts"))
    ws = Window.partitionBy(*keys).orderBy("__bucket")
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    heads = summary.select(
        *keys, "__bucket", F.lit(0).alias("__flag"),
        *[F.last(F.col(f"__last_{c}"), ignorenulls=True).over(before).alias(c) for c in cols],
        *[F.lag(f"__lastrow_{c}").over(ws).alias(c) for c in lag_src],
        F.lag("__max_ts").over(ws).alias(ts))
    synthetic = heads
    if next_col:
        tails = summary.select(*keys, "__bucket", F.lit(2).alias("__flag"),
                               F.lead("__min_ts").over(ws).alias(ts))
        synthetic = heads.unionByName(tails, allowMissingColumns=True)
    u = x.unionByName(synthetic, allowMissingColumns=True)
    wb = Window.partitionBy(*keys, "__bucket").orderBy(
        F.col("__flag"), F.col(ts).asc(), *[F.col(t).asc_nulls_last() for t in tiebreak])
    scan = {c: F.last(F.col(c), ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, Window.currentRow))
            for c in cols}
    for out_col, src in lags.items():
        scan[out_col] = F.lag(F.col(src)).over(wb)
    if next_col:
        scan[next_col] = F.lead(F.col(ts)).over(wb)
    return u.withColumns(scan).filter(F.col("__flag") == 1).drop("__bucket", "__flag")


def forward_fill(df: DataFrame, key: Sequence[str] | str, ts: str, cols: Sequence[str],
                 tiebreak: Sequence[str] = (), split_by: Column | Measured | None = None) -> DataFrame:
    """Replace NULLs by the last non-NULL value *up to the current row*.

    ``last(c, ignorenulls) OVER (PARTITION BY key ORDER BY ts ASC ROWS
    BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)``: ascending order, so no
    value from the future leaks backwards. All columns share one window
    spec, hence one shuffle and one sort. With ``split_by`` (a time bucket)
    the scan runs per (key, bucket) plus a carry between buckets, so one hot
    key is not a single task.
    """
    if split_by is not None:
        keys = [key] if isinstance(key, str) else list(key)
        return _bucketed_scan(df, keys, ts, tiebreak, cols, split_by).select(*df.columns)
    w = _window(key, ts, tiebreak).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in cols})


def scd2(events: DataFrame, key: Sequence[str] | str, ts: str, fill_cols: Sequence[str],
         start_default: str | None = None, tiebreak: Sequence[str] = (),
         effective: Mapping[str, Sequence[str]] | None = None,
         attribute_timing: str = "closes", open_end: dt.date | str | None = "9999-12-31",
         start_col: str = "valid_from", end_col: str = "valid_to",
         passthrough: Sequence[str] = (), split_by: Column | Measured | None = None, keep_empty: bool = False) -> DataFrame:
    """Half-open validity intervals ``[start, end)`` from an event timeline.

    ``attribute_timing="closes"`` (reference semantics): each event *ends* an
    interval, ``end = ts`` and ``start = coalesce(lag(ts), start_default, ts)``;
    the attributes forward-filled up to the event describe the interval it
    closes. ``"opens"``: each event starts an interval, ``start = ts`` and
    ``end = coalesce(lead(ts), open_end)``.

    ``effective`` maps a date column to columns that only hold once that
    date is before the interval end (``CASE WHEN d < end THEN c END``), e.g.
    a termination date and its reason. ``start_default`` is read *unfilled*,
    as in the reference. Intervals with ``end <= start`` (two events on one
    day, first event at its own start) are dropped, unless ``keep_empty`` leaves
    that to an expectation. ``tiebreak`` orders same-timestamp events deterministically.

    lag/lead and the fills share one window spec: one exchange by key and
    one sort. Output: key, filled columns, effective columns, passthrough,
    ``ts``, start, end. ``split_by`` (a non-decreasing time bucket of ``ts``)
    switches to the two-phase bucketed scan for keys too hot for one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    w = _window(keys, ts, tiebreak)
    frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if attribute_timing == "closes":
        start_parts = [F.lag(F.col(ts)).over(w)]
        if start_default is not None:
            start_parts.append(F.col(start_default))
        start_parts.append(F.col(ts))
        bounds = {end_col: F.col(ts), start_col: F.coalesce(*start_parts)}
    elif attribute_timing == "opens":
        end_parts = [F.lead(F.col(ts)).over(w)]
        if open_end is not None:
            end_parts.append(_lit_date(open_end))
        bounds = {start_col: F.col(ts), end_col: F.coalesce(*end_parts)}
    else:
        raise ValueError("attribute_timing must be 'closes' or 'opens'")
    if split_by is not None:
        # keep the unfilled start_default aside: the bucketed scan fills in place
        src = events.withColumn("__start_default", F.col(start_default)) if start_default else events
        scanned = _bucketed_scan(src, keys, ts, tiebreak, fill_cols, split_by,
                                 prev_col="__prev_ts" if attribute_timing == "closes" else None,
                                 next_col="__next_ts" if attribute_timing == "opens" else None)
        if attribute_timing == "closes":
            parts = [F.col("__prev_ts")] + ([F.col("__start_default")] if start_default else []) + [F.col(ts)]
            bnd = {end_col: F.col(ts), start_col: F.coalesce(*parts)}
        else:
            nparts = [F.col("__next_ts")] + ([_lit_date(open_end)] if open_end is not None else [])
            bnd = {start_col: F.col(ts), end_col: F.coalesce(*nparts)}
        out = scanned.withColumns(bnd)
    else:
        filled = {c: F.last(F.col(c), ignorenulls=True).over(frame) for c in fill_cols}
        # One withColumns: every expression reads the *input* row, so start uses the
        # unfilled start_default even when that column is also forward-filled.
        out = events.withColumns({**bounds, **filled})
    eff_cols: list[str] = []
    for guard, cols in (effective or {}).items():
        cond = F.col(guard) < F.col(end_col)
        out = out.withColumns({c: F.when(cond, F.col(c)) for c in cols})
        eff_cols.extend(c for c in cols if c not in eff_cols)
    ordered = keys + [c for c in fill_cols if c not in keys] + eff_cols + \
        [c for c in passthrough if c not in eff_cols] + [ts, start_col, end_col]
    return (out if keep_empty else out.filter(F.col(end_col) > F.col(start_col))).select(*ordered)


def scd2_overlaps(intervals: DataFrame, key: Sequence[str] | str, start: str = "valid_from",
                  end: str = "valid_to", split_by: Column | Measured | None = None) -> DataFrame:
    """Intervals that start before the previous one ended (must be empty).

    ``LAG(end) OVER (PARTITION BY key ORDER BY start, end)``. With
    ``split_by`` (a non-decreasing bucket of ``start``) the lag runs per
    (key, bucket) with the previous bucket's last end carried in, so a key
    with a very long history is not one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if split_by is not None:
        s = _bucketed_scan(intervals.select(*keys, start, end), keys, start, [end], [], split_by,
                           lags={"previous_end": end})
        return s.select(*keys, start, end, "previous_end").filter(F.col("previous_end") > F.col(start))
    w = Window.partitionBy(*keys).orderBy(F.col(start).asc(), F.col(end).asc_nulls_last())
    return (intervals.select(*keys, start, end, F.lag(F.col(end)).over(w).alias("previous_end"))
            .filter(F.col("previous_end") > F.col(start)))


def history_variation(intervals: DataFrame, key: Sequence[str] | str, attr: str,
                      distinct_col: str = "n_distinct_values", count_col: str = "n_keys") -> DataFrame:
    """Histogram of distinct attribute values per key.

    If every key shows exactly one value the fill ran backwards (or the
    history never varies). Two partially aggregated group-bys, no window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    per_key = intervals.groupBy(*keys).agg(F.count_distinct(F.col(attr)).alias(distinct_col))
    return per_key.groupBy(distinct_col).agg(F.count(F.lit(1)).alias(count_col))
