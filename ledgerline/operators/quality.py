"""W1, W20-W22, W24, W25 — profiles, DQ panel, gate, reconciliation, expectations, parity."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.columns import passes
from ledgerline.operators.integrity import row_counts

# The severity vocabulary of the panel and its display order.
SEVERITY_ORDER = ("erro", "atencao", "informativo", "ok")


# --------------------------------------------------------------------------- W1
def profile(df: DataFrame, keys: Sequence[str] | None = None,
            rules: Mapping[str, Column] | None = None) -> DataFrame:
    """One pass, one row: row count, duplicate keys and one counter per rule.

    ``n_duplicate_keys = count(*) - count(DISTINCT keys)``; each rule is a
    predicate counted with ``count_if`` (NULL does not count).
    """
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if keys:
        aggs.append((F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).alias("n_duplicate_keys"))
    for name, pred in (rules or {}).items():
        aggs.append(F.count_if(pred).alias(name))
    return df.agg(*aggs)


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column ``(column_name, n_rows, n_nulls, all_null)`` from one aggregate.

    A 100 %-NULL column is the classic decoy: a join on it "works" and
    returns nothing. The wide one-row aggregate is unpivoted into rows.
    """
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"__null_{i}") for i, c in enumerate(cols)])
    rows = wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col("__n").alias("n_rows"),
                 F.col(f"__null_{i}").alias("n_nulls")) for i, c in enumerate(cols)])))
    return rows.withColumn("all_null", (F.col("n_nulls") == F.col("n_rows")) & (F.col("n_rows") > 0))


# ------------------------------------------------------------------ W20-W22
@dataclass
class Metric:
    """One panel row: an aggregate over one source and its severity rule.

    ``severity`` is a fixed label or a function from the value Column to a
    label Column (for example ``lambda v: F.when(v > 0, "atencao").otherwise("ok")``).
    """

    name: str
    source: str
    value: Column
    severity: str | Callable[[Column], Column] = "informativo"


@dataclass
class Reconciliation:
    """``round(abs(sum_left - sum_right), 2)``; ``erro`` beyond ``tolerance``.

    An empty side (NULL sum) is ``erro`` too, so an empty gold cannot pass.
    """

    name: str
    left_source: str
    left_value: Column
    right_source: str
    right_value: Column
    tolerance: float = 0.01
    extra: dict = field(default_factory=dict)


def _severity(rule, value: Column) -> Column:
    return F.lit(rule) if isinstance(rule, str) else rule(value)


def dq_panel(sources: Mapping[str, DataFrame], metrics: Sequence[Metric],
             reconciliations: Sequence[Reconciliation] = ()) -> DataFrame:
    """Rows ``(metric, value STRING, severity)``.

    Every source is aggregated **once** for all of its metrics (and the
    reconciliation totals it contributes); the per-source one-row results
    are unpivoted and stacked. Reconciliation totals from two sources meet
    in a global aggregate over two rows, so no join is needed.
    """
    per_source: dict[str, list] = {}
    for i, m in enumerate(metrics):
        per_source.setdefault(m.source, []).append((f"__m{i}", m))
    recon_parts: dict[str, list] = {}
    for j, r in enumerate(reconciliations):
        recon_parts.setdefault(r.left_source, []).append((f"__r{j}_l", r.left_value))
        recon_parts.setdefault(r.right_source, []).append((f"__r{j}_r", r.right_value))

    # Each source is aggregated once into one row, and that row is read once:
    # its metric rows and its reconciliation parts leave in the same inline.
    # (Two readers would let column pruning split it into two aggregates, i.e.
    # two full scans of the source.)
    part_of = {f"__r{j}_{side}": r.name for j, r in enumerate(reconciliations) for side in ("l", "r")}
    stacked = None
    for src in dict.fromkeys([*per_source, *recon_parts]):
        ms = per_source.get(src, [])
        rs = recon_parts.get(src, [])
        one = sources[src].agg(*[m.value.alias(a) for a, m in ms], *[v.alias(a) for a, v in rs])
        rows = [F.struct(F.lit(m.name).alias("metric"), F.col(a).cast("string").alias("value"),
                         _severity(m.severity, F.col(a)).cast("string").alias("severity"),
                         F.lit(None).cast("string").alias("part"), F.lit(None).cast("decimal(38,4)").alias("total"))
                for a, m in ms]
        rows += [F.struct(F.lit(part_of[a]).alias("metric"), F.lit(None).cast("string").alias("value"),
                          F.lit(None).cast("string").alias("severity"), F.lit(a).alias("part"),
                          F.col(a).cast("decimal(38,4)").alias("total"))
                 for a, _ in rs]
        part = one.select(F.inline(F.array(*rows)))
        stacked = part if stacked is None else stacked.unionByName(part)
    if not reconciliations:
        return stacked.select("metric", "value", "severity")
    # Fold the few stacked rows: metric rows pass through (one row per metric),
    # the two parts of each reconciliation meet in its own group.
    aggs = [F.first("value", ignorenulls=True).alias("value"), F.first("severity", ignorenulls=True).alias("severity")]
    for p in part_of:
        aggs.append(F.max(F.when(F.col("part") == p, F.col("total"))).alias(p))
    folded = stacked.groupBy("metric").agg(*aggs)
    value, severity = F.col("value"), F.col("severity")
    for j, r in enumerate(reconciliations):
        left, right = F.col(f"__r{j}_l"), F.col(f"__r{j}_r")
        diff = F.round(F.abs(F.coalesce(left, F.lit(0)) - F.coalesce(right, F.lit(0))), 2)
        bad = left.isNull() | right.isNull() | (diff > F.lit(r.tolerance))
        is_r = F.col("metric") == F.lit(r.name)
        value = F.when(is_r, diff.cast("decimal(38,2)").cast("string")).otherwise(value)
        severity = F.when(is_r, F.when(bad, F.lit("erro")).otherwise(F.lit("ok"))).otherwise(severity)
    return folded.select("metric", value.alias("value"), severity.alias("severity"))


def severity_rank(col: str = "severity") -> Column:
    rank = None
    for i, s in enumerate(SEVERITY_ORDER, start=1):
        rank = F.when(F.col(col) == s, F.lit(i)) if rank is None else rank.when(F.col(col) == s, F.lit(i))
    return rank.otherwise(F.lit(len(SEVERITY_ORDER) + 1))


def ordered_panel(panel: DataFrame) -> DataFrame:
    """The panel sorted by severity (erro first), then metric name."""
    return panel.orderBy(severity_rank(), F.col("metric"))


def quality_gate(panel: DataFrame, fail_on: str = "erro") -> DataFrame:
    """The rows that block publication (must be empty)."""
    return panel.filter(F.col("severity") == fail_on)


def assert_gate(panel: DataFrame, fail_on: str = "erro") -> None:
    """Raise if the gate has rows; one small aggregate, no collect of data."""
    found = quality_gate(panel, fail_on).agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_set("metric")).alias("metrics")).first()
    if found["n"]:
        raise AssertionError(f"quality gate failed: {found['n']} rows, metrics {found['metrics']}")


def reconcile(left: DataFrame, right: DataFrame, left_measure: str, right_measure: str,
              name: str = "reconciliation", tolerance: float = 0.01, by: Sequence[str] = ()) -> DataFrame:
    """Stand-alone reconciliation row ``(metric, value, severity)``.

    With ``by`` one row per group ``(*by, left_total, right_total, value, severity)``,
    so errors that cancel out in the total are seen. A group that one side lacks
    is ``erro``. Both sides are tagged, unioned and summed by one partially
    aggregated group-by (one shuffle, no join).
    """
    if by:
        amount = "decimal(38,2)"
        none = F.lit(None).cast(amount)
        rows = left.select(*by, F.col(left_measure).cast(amount).alias("l"), none.alias("r")).unionByName(
            right.select(*by, none.alias("l"), F.col(right_measure).cast(amount).alias("r")))
        sums = rows.groupBy(*by).agg(F.sum("l").cast(amount).alias("left_total"), F.sum("r").cast(amount).alias("right_total"))
        gap = F.abs(F.coalesce("left_total", F.lit(0)) - F.coalesce("right_total", F.lit(0))).cast(amount)
        agrees = F.col("left_total").isNotNull() & F.col("right_total").isNotNull() & (gap <= F.lit(tolerance))
        return sums.select(*by, "left_total", "right_total", gap.alias("value"),
                           F.when(agrees, F.lit("ok")).otherwise(F.lit("erro")).alias("severity"))
    return dq_panel({"__left": left, "__right": right}, [], [Reconciliation(
        name, "__left", F.sum(F.col(left_measure)), "__right", F.sum(F.col(right_measure)), tolerance)])


# ---------------------------------------------------------------------- W24
def expect(df: DataFrame, expectations: Mapping[str, tuple[Column, str]],
           observe: bool = False) -> tuple[DataFrame, DataFrame | Observation]:
    """Named predicates with action ``drop`` or ``warn``.

    Returns ``(kept, metrics)``: ``kept`` drops rows failing any ``drop``
    expectation (a NULL predicate is a failure); ``metrics`` has one row per
    expectation ``(expectation, action, n_passed, n_failed)`` from a single
    aggregate pass over the input.

    With ``observe=True`` the counters ride along the pass that consumes
    ``kept`` (``DataFrame.observe``, evaluated by the tasks of that job, as
    a declarative pipeline counts while it writes): ``metrics`` is then an
    ``Observation``; after the first action on ``kept`` read it with
    :func:`observed_expectations`. No second scan of the input.
    """
    for name, (_, action) in expectations.items():
        if action not in ("drop", "warn"):
            raise ValueError(f"{name}: action must be 'drop' or 'warn'")
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, (name, (pred, _)) in enumerate(expectations.items()):
        aggs.append(F.count_if(passes(pred)).alias(f"__p{i}"))
    if observe:
        obs = Observation("expectations")
        kept = df.observe(obs, *aggs)
        for name, (pred, action) in expectations.items():
            if action == "drop":
                kept = kept.filter(passes(pred))
        return kept, obs
    one = df.agg(*aggs)
    metrics = one.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("expectation"), F.lit(action).alias("action"),
                 F.col(f"__p{i}").alias("n_passed"), (F.col("__n") - F.col(f"__p{i}")).alias("n_failed"))
        for i, (name, (_, action)) in enumerate(expectations.items())]).cast(
            "array<struct<expectation:string,action:string,n_passed:bigint,n_failed:bigint>>")))
    kept = df
    for name, (pred, action) in expectations.items():
        if action == "drop":
            kept = kept.filter(passes(pred))
    return kept, metrics


def observed_expectations(obs: Observation, expectations: Mapping[str, tuple[Column, str]]) -> list[dict]:
    """The counters of :func:`expect` (``observe=True``) as one dict per
    expectation; available once an action on the kept rows has run."""
    got = obs.get
    return [{"expectation": name, "action": action, "n_passed": got[f"__p{i}"],
             "n_failed": got["__n"] - got[f"__p{i}"]}
            for i, (name, (_, action)) in enumerate(expectations.items())]


def counted(df: DataFrame, expectations: Mapping[str, tuple[Column, str]]) -> tuple[DataFrame, Observation]:
    """``df`` itself with the counters of its expectations observed by the job that writes it.

    The observation stands at the top of the plan, so the writing tasks count the
    rows that they write (each successful task once) and no aggregate reads the
    dataset again. Read it with :func:`expectation_rows` after the write.
    """
    obs = Observation("expectations")
    return df.observe(obs, F.count(F.lit(1)).alias("__n"), *[
        F.count_if(passes(ok)).alias(f"__p{i}") for i, (ok, _) in enumerate(expectations.values())]), obs


def expectation_rows(df: DataFrame, expectations: Mapping[str, tuple[Column, str]], obs: Observation | None = None) -> DataFrame:
    """Rows (expectation, action, n_passed, n_failed): from an observation, or else by one aggregate over ``df``."""
    if obs is None:
        return expect(df, expectations)[1]
    rows = [tuple(r.values()) for r in observed_expectations(obs, expectations)]
    return df.sparkSession.createDataFrame(rows, "expectation string, action string, n_passed long, n_failed long")


# ---------------------------------------------------------------------- W25
def parity(a: DataFrame, b: DataFrame, keys: Sequence[str], dataset: str = "dataset",
           values: Sequence[str] = ()) -> DataFrame:
    """Compare two builds of one dataset on its keys.

    One row ``(dataset, rows_a, rows_b, only_a, only_b)``: ``only_a`` counts
    the rows of ``a`` whose key has no row in ``b`` (anti-join semantics: a
    NULL key never matches); a faithful twin has equal counts and zeros.
    Both key sets are tagged, unioned and counted per key with one
    partially aggregated group-by (one shuffle, hot keys combined map-side)
    instead of two anti joins. With ``values``, ``n_differing`` counts the keys
    of both builds whose hashed values (NULLs included) don't add up alike.
    """
    keys = list(keys)
    parts = [e for v in values for e in (F.col(v), F.col(v).isNull())]
    held = F.xxhash64(*parts).cast("decimal(38,0)") if values else F.lit(0).cast("decimal(38,0)")
    tagged = a.select(*keys, F.lit(1).alias("__a"), F.lit(0).alias("__b"), held.alias("__h")).unionByName(
        b.select(*keys, F.lit(0).alias("__a"), F.lit(1).alias("__b"), (-held).cast("decimal(38,0)").alias("__h")))
    per_key = tagged.groupBy(*keys).agg(F.sum("__a").alias("__na"), F.sum("__b").alias("__nb"), F.sum("__h").alias("__gap"))
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    z = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return per_key.agg(
        z(F.sum("__na")).alias("rows_a"), z(F.sum("__nb")).alias("rows_b"),
        z(F.sum(F.when((F.col("__nb") == 0) | null_key, F.col("__na")))).alias("only_a"),
        z(F.sum(F.when((F.col("__na") == 0) | null_key, F.col("__nb")))).alias("only_b"),
        F.count_if((F.col("__na") > 0) & (F.col("__nb") > 0) & ~null_key & (F.col("__gap") != 0)).alias("n_differing"),
    ).select(F.lit(dataset).alias("dataset"), "rows_a", "rows_b", "only_a", "only_b", *(["n_differing"] if values else []))
