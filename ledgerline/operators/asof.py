"""W15 — as-of (interval) join against SCD2 validity intervals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.buckets import Measured, measured_buckets
from ledgerline.operators.history import forward_fill


def asof_join(fact: DataFrame, intervals: DataFrame, key: Sequence[str] | str, at: str,
              cols: Sequence[str], start: str = "valid_from", end: str = "valid_to",
              how: str = "inner", grain: Sequence[str] | None = None,
              keep_bounds: bool = False, method: str = "scan",
              split_by: str | Callable[[Column], Column] | Measured | None = None) -> DataFrame:
    """Attach the interval attributes valid at ``fact[at]``: ``start <= at < end``.

    The end is exclusive, so a fact dated exactly on a boundary matches the
    later interval only. ``how="left"`` keeps facts without a valid interval
    (attributes NULL); ``"inner"`` drops them, as the reference does (count
    them with W23). Among several intervals holding ``at`` the one with the
    latest start (then latest end) wins, so each fact gets at most one match.

    ``method="scan"`` (default) is linear in the input: facts and intervals
    are unioned into one timeline per key, intervals sorted before facts of
    the same instant, and the latest interval (one struct, so NULL
    attributes are not filled from an older interval) is carried forward to
    each fact with ``last(..., ignorenulls)``; the fact then checks
    ``at < end``. One exchange on the key, one sort, no pairs are formed.
    It is exact when the intervals of a key do not overlap, which SCD2
    intervals guarantee (checked by W14). ``split_by`` (a ``date_trunc``
    unit such as ``"day"``, or a function of the time column returning a
    non-decreasing bucket) spreads a key holding a large share of the rows
    over its time buckets with the two-phase scan of W13; :class:`Measured`
    takes the buckets of hot keys from quantiles of their own rows.

    ``method="sweep"`` is for intervals that may overlap: they are first split
    into disjoint ones (:func:`disjoint_intervals`, the latest start wins), which
    the same scan then serves. Linear too; no facts x intervals pairs.

    ``method="range"`` is the literal reference form for overlapping
    intervals: equality on the key plus a residual range predicate, then a
    ``row_number`` guard over ``grain`` (default key + ``at``). Its cost is
    facts x intervals per key, so use it only where histories are short.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if method == "range":
        return _range_asof(fact, intervals, keys, at, cols, start, end, how, grain, keep_bounds)
    if method not in ("scan", "sweep"):
        raise ValueError("method must be 'scan', 'sweep' or 'range'")
    bounds = (start, end)
    if method == "sweep":
        bounds = ("__first", "__last")
        intervals = disjoint_intervals(intervals.select(
            *keys, start, end, F.col(start).alias("__first"), F.col(end).alias("__last"), *[c for c in cols if c not in keys]),
            keys, start, end, parts=split_by.parts if isinstance(split_by, Measured) else None)

    kcols = [f"__k{i}" for i in range(len(keys))]
    # An interval without key, start or end, or with end <= start, can never
    # hold a fact: leave it out so it cannot shadow an earlier interval.
    valid = F.lit(True)
    for k in keys:
        valid = valid & F.col(k).isNotNull()
    valid = valid & F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(end) > F.col(start))
    iv = intervals.filter(valid).select(
        *[F.col(k).alias(kc) for k, kc in zip(keys, kcols)],
        F.col(start).alias("__t"), F.lit(0).alias("__kind"),
        F.col(start).alias("__o_from"), F.col(end).alias("__o_to"),
        F.struct(F.col(bounds[0]).alias("__from"), F.col(bounds[1]).alias("__to"), F.col(end).alias("__until"),
                 *[F.col(c) for c in cols]).alias("__iv"))
    if how == "inner":       # a fact without key can't match: it is not shuffled into one group
        fact = fact.dropna(subset=keys)
    fx = fact.select("*", *[F.col(k).alias(kc) for k, kc in zip(keys, kcols)],
                     F.col(at).alias("__t"), F.lit(1).alias("__kind"))
    timeline = fx.unionByName(iv, allowMissingColumns=True)
    bucket = None
    if isinstance(split_by, Measured):
        bucket = split_by
    elif split_by is not None:
        bucket = F.date_trunc(split_by, F.col("__t")) if isinstance(split_by, str) else split_by(F.col("__t"))
    filled = forward_fill(timeline, kcols, "__t", ["__iv"], tiebreak=["__kind", "__o_from", "__o_to"],
                          split_by=bucket)
    hit = F.col("__iv").isNotNull() & (F.col("__t") < F.col("__iv.__until"))
    out = filled.filter(F.col("__kind") == 1)
    if how == "inner":
        out = out.filter(hit)
        pick = {c: F.col(f"__iv.{c}") for c in cols}
        bounds = [F.col("__iv.__from").alias(start), F.col("__iv.__to").alias(end)]
    else:
        pick = {c: F.when(hit, F.col(f"__iv.{c}")) for c in cols}
        bounds = [F.when(hit, F.col("__iv.__from")).alias(start), F.when(hit, F.col("__iv.__to")).alias(end)]
    return out.select(*[F.col(c) for c in fact.columns], *(bounds if keep_bounds else []),
                      *[v.alias(c) for c, v in pick.items()])


def disjoint_intervals(intervals: DataFrame, key: Sequence[str] | str, start: str = "valid_from", end: str = "valid_to",
                       parts: int | None = None) -> DataFrame:
    """Split the overlapping intervals of a key into disjoint ones; at every instant the latest start (then latest end) wins.

    A sweep over the intervals in order of their starts. An interval that ends
    before a later-started one does can never win again, so what is held is a
    stack whose ends fall from bottom to top: as many rows as intervals are
    nested, not as many as a key has. One exchange on the key and one sort; the
    columns stay, ``start`` and ``end`` become the bounds of the piece. Intervals
    without key, start or end, and empty ones, go: they hold nothing. Among equal
    bounds the other columns decide, so the result doesn't depend on row order.

    With ``parts``, a key with more than 1 / ``parts`` of all intervals is cut at
    quantiles of its starts: an interval is handed to every bucket it reaches
    into, and each (key, bucket) is swept on its own, so a hot key is spread.
    """
    keys = [key] if isinstance(key, str) else list(key)
    names = intervals.columns
    held = F.lit(True)
    for c in [*keys, start, end]:
        held = held & F.col(c).isNotNull()
    rows = intervals.where(held & (F.col(end) > F.col(start))).withColumns({"__a": F.col(start), "__b": F.col(end), "__cell": F.lit(0)})
    if parts:
        rows = _cut_hot_keys(rows, keys, start, end, parts)
    order = ["__a", start, end, *[c for c in names if c not in (*keys, start, end)]]
    sortable = [c for c in order if "map<" not in rows.schema[c].dataType.simpleString()]
    dealt = rows.repartition(*keys, "__cell").sortWithinPartitions(*keys, "__cell", *sortable)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    swept = dealt.mapInArrow(lambda batches: _sweep(batches, [*keys, "__cell"]), schema)
    return swept.withColumns({start: F.col("__a"), end: F.col("__b")}).select(*names)


def _cut_hot_keys(rows: DataFrame, keys: list[str], start: str, end: str, parts: int) -> DataFrame:
    """Pieces of the intervals per bucket of their key (``__cell``); keys that aren't hot have one bucket."""
    # starts that are boundaries of hot keys: the first start of each measured bucket
    firsts = (measured_buckets(rows.select(*keys, start), keys, [start], parts).groupBy(*keys, "__bucket")
              .agg(F.min(start).alias("__first")).groupBy(*keys)
              .agg(F.array_sort(F.collect_set("__first")).alias("__firsts")).where(F.size("__firsts") > 1))
    joined = rows.join(firsts, keys, "left")
    at = F.coalesce("__firsts", F.array(F.col(start)))
    cells = F.transform(at, lambda lo, i: F.struct(
        i.cast("int").alias("cell"), lo.alias("lo"), F.coalesce(F.get(at, i + 1), F.col(end)).alias("hi"),
        (i == 0).alias("first"), (i == F.size(at) - 1).alias("final")))
    pieces = joined.select("*", F.explode(F.filter(cells, lambda c: (c["final"] | (c["hi"] > F.col(start))) & (c["first"] | (c["lo"] < F.col(end))))).alias("__c"))
    return pieces.withColumns({
        "__a": F.when(F.col("__c.first"), F.col(start)).otherwise(F.greatest(F.col(start), F.col("__c.lo"))),
        "__b": F.when(F.col("__c.final"), F.col(end)).otherwise(F.least(F.col(end), F.col("__c.hi"))),
        "__cell": F.col("__c.cell")}).drop("__firsts", "__c")


def _sweep(batches: Iterator[pa.RecordBatch], group: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group and ``__a`` (later rows win) -> pieces [__a, __b) of the winning rows."""
    out, stack, now, at, schema = [], [], None, None, None

    def upto(limit) -> None:
        """Give the pieces from ``at`` to ``limit`` (None: to the end of the stack)."""
        nonlocal at
        while stack:
            top = stack[-1]
            to = top["__b"] if limit is None or top["__b"] <= limit else limit
            if at < to:
                out.append({**top, "__a": at, "__b": to})
                at = to
            if limit is not None and top["__b"] > limit:
                return
            stack.pop()

    for batch in batches:
        schema = batch.schema
        for row in batch.to_pylist():
            cell = [row[c] for c in group]
            if cell != now:
                upto(None)
                now = cell
            else:
                upto(row["__a"])
            at = row["__a"]
            while stack and stack[-1]["__b"] <= row["__b"]:
                stack.pop()             # it ends under the new one
            stack.append(row)
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out.clear()
    upto(None)
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


@dataclass(frozen=True)
class History:
    """Change events of one kind: at ``ts`` the non-NULL ones of ``cols`` take new values; ``order`` breaks ties."""

    events: DataFrame
    ts: str
    cols: Sequence[str]
    order: Sequence[str] = ()


def asof_timeline(fact: DataFrame, histories: Sequence[History], key: Sequence[str] | str, at: str,
                  split_by: str | Callable[[Column], Column] | Measured | None = None) -> DataFrame:
    """Attach to each fact the state of several histories at ``fact[at]``: the last known value of every column.

    All histories and the facts are one timeline per key: a single forward fill
    over it, with one exchange of the rows, where building intervals for each
    history and joining them would move the rows once per history and once
    more for the facts. A change at the very instant of a fact counts, as in
    half-open intervals. Facts without key or before the first change have
    NULLs. Column names of the histories must differ.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kcols = [f"__k{i}" for i in range(len(keys))]
    names = [c for h in histories for c in h.cols]
    if len({*names}) < len(names) or {*names} & {*fact.columns}:
        raise ValueError("columns of the histories and the fact must differ")
    depth = max([len(h.order) for h in histories], default=0)
    line = fact.select("*", *[F.col(k).alias(kc) for k, kc in zip(keys, kcols)], F.col(at).alias("__t"), F.lit(1).alias("__fact"))
    for h in histories:
        known = h.events.dropna(subset=[*keys, h.ts])
        line = line.unionByName(known.select(
            *[F.col(k).alias(kc) for k, kc in zip(keys, kcols)], F.col(h.ts).alias("__t"), F.lit(0).alias("__fact"),
            *[F.col(c) for c in h.cols], *[F.col(c).alias(f"__o{i}") for i, c in enumerate(h.order)]), allowMissingColumns=True)
    bucket = split_by
    if isinstance(split_by, str):
        bucket = F.date_trunc(split_by, F.col("__t"))
    elif split_by is not None and not isinstance(split_by, Measured):
        bucket = split_by(F.col("__t"))
    filled = forward_fill(line, kcols, "__t", names, tiebreak=["__fact", *[f"__o{i}" for i in range(depth)]], split_by=bucket)
    known = F.lit(True)
    for k in [*kcols, "__t"]:
        known = known & F.col(k).isNotNull()
    return filled.where("__fact = 1").select(*[F.col(c) for c in fact.columns], *[F.when(known, F.col(c)).alias(c) for c in names])


def _range_asof(fact: DataFrame, intervals: DataFrame, keys: list[str], at: str, cols: Sequence[str],
                start: str, end: str, how: str, grain: Sequence[str] | None, keep_bounds: bool) -> DataFrame:
    right = intervals.select(*[F.col(k).alias(f"__k_{k}") for k in keys],
                             F.col(start).alias("__from"), F.col(end).alias("__to"), *cols)
    cond = None
    for k in keys:
        c = fact[k] == right[f"__k_{k}"]
        cond = c if cond is None else cond & c
    cond = cond & (fact[at] >= right["__from"]) & (fact[at] < right["__to"])
    joined = fact.join(right, cond, how)
    grain = list(grain) if grain else keys + [at]
    w = Window.partitionBy(*grain).orderBy(F.col("__from").desc_nulls_last(), F.col("__to").desc_nulls_last())
    out = (joined.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1)
           .drop("__rn", *[f"__k_{k}" for k in keys]))
    if keep_bounds:
        return out.withColumnsRenamed({"__from": start, "__to": end})
    return out.drop("__from", "__to")
