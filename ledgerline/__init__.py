"""ledgerline: PySpark operators for trustworthy analytical tables.

Every public operator is a function DataFrame(s) -> DataFrame(s), parameterised
by column names and built only from Spark's built-in Column expressions, so
Catalyst plans it (pushdown, pruning, codegen) and AQE re-plans it at run time.
"""

from ledgerline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
