"""Reusable Column builders.

Nothing here touches data: each function returns a Column that Catalyst
folds into the surrounding projection, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def any_not_null(cols: Sequence[ColumnOrName]) -> Column:
    """``(a IS NOT NULL OR b IS NOT NULL ...)`` as one parenthesised block.

    Building the OR block as its own Column is what keeps a caller's
    ``flag & any_not_null(...)`` from being read as ``(flag AND a) OR b``.
    """
    return reduce(or_, [_col(c).isNotNull() for c in cols])


def decode(code: ColumnOrName, mapping: Mapping[object, str], default: str | None = None) -> Column:
    """``CASE code WHEN k THEN v ... ELSE default END`` for a small fixed domain."""
    code = _col(code)
    out = None
    for k, v in mapping.items():
        out = F.when(code == F.lit(k), F.lit(v)) if out is None else out.when(code == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out.otherwise(F.lit(default))


def passes(predicate: Column) -> Column:
    """True only when the predicate is TRUE; NULL counts as a failure."""
    return F.coalesce(predicate, F.lit(False))


def first_failing(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule (in declared order) whose check is not TRUE.

    ``rules`` are ``(reason, ok_predicate)`` pairs. The result is NULL when
    every check passes. A check that evaluates to NULL is a failure, so a
    row can never fall out of both the valid and the rejected side.
    """
    return F.coalesce(*[F.when(~passes(ok), F.lit(reason)) for reason, ok in rules])


def safe_ratio(num: ColumnOrName, den: ColumnOrName, scale: int | None = None,
               factor: float | None = None) -> Column:
    """``round(factor * num / NULLIF(den, 0), scale)`` computed in DOUBLE.

    Operands are cast to double first so a zero or empty denominator gives
    NULL instead of an ANSI division error, and the result does not depend
    on decimal precision rules.
    """
    n = _col(num).cast("double")
    if factor is not None:
        n = F.lit(float(factor)) * n
    r = n / F.nullif(_col(den).cast("double"), F.lit(0.0))
    return F.round(r, scale) if scale is not None else r


def decimal_ratio(num: ColumnOrName, den: ColumnOrName, scale: int = 2) -> Column:
    """``round(num / NULLIF(den, 0), scale)`` in exact DECIMAL arithmetic.

    For money over a count (mean cost per claim) the quotient is exact to
    12+ places before the HALF_UP rounding, so ties like ``x.xx5`` round up
    as they do on paper (a DOUBLE quotient may sit just below the tie).
    """
    return F.round(_col(num) / F.nullif(_col(den), F.lit(0)), scale)


def month_int(d: ColumnOrName) -> Column:
    """yyyyMM as INT from a date or timestamp."""
    d = _col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def quarter_int(d: ColumnOrName) -> Column:
    """yyyyQ as INT (e.g. 20011) from a date or timestamp."""
    d = _col(d)
    return (F.year(d) * 10 + F.quarter(d)).cast("int")


def month_start(month: ColumnOrName) -> Column:
    """First day of a yyyyMM integer month."""
    return F.to_date(_col(month).cast("string"), "yyyyMM")


def hash_bucket(cols: Sequence[ColumnOrName], salt: str, k: int) -> Column:
    """Repeatable bucket in ``[0, k)`` from Murmur3 of the row key and a salt.

    Different salts give independent buckets for the same key.
    """
    return F.pmod(F.hash(*[_col(c) for c in cols], F.lit(salt)), F.lit(k))


def mod_bucket(key: ColumnOrName, k: int) -> Column:
    """Arithmetic bucket ``pmod(key, k)`` for an integral key (portable to any SQL engine)."""
    return F.pmod(_col(key), F.lit(k))
