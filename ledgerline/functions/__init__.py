"""Column-expression helpers (all JVM-side built-ins, codegen friendly)."""

from ledgerline.functions.columns import (
    any_not_null, decode, first_failing, month_int, month_start, quarter_int,
    safe_ratio, decimal_ratio, passes, hash_bucket, mod_bucket,
)

__all__ = [
    "any_not_null", "decode", "first_failing", "month_int", "month_start", "quarter_int",
    "safe_ratio", "decimal_ratio", "passes", "hash_bucket", "mod_bucket",
]
