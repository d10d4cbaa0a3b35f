"""NaN/NULL-aware predicates and arithmetic.

Spark (like DuckDB) orders NaN above every number, so ``NaN > 0`` is
true, and ``NOT isnan(NULL)`` is NULL, which a filter drops but a
``CASE`` does not.  These helpers spell out the intended rule once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_not_nan(col) -> Column:
    """True only for a real number: rejects NULL *and* NaN.

    The column-store rule ``isNaN(x) != 1`` yields NULL for NULL, so the
    row is dropped; plain ``NOT isnan(x)`` would keep NULLs in Spark.
    """
    c = _c(col)
    return c.isNotNull() & ~F.isnan(c)


def is_non_negative(col) -> Column:
    """``(c > 0) OR (c = 0)`` with the column-store meaning: NaN rejected."""
    c = _c(col)
    return is_not_nan(c) & (c >= 0)


def nan_to_null(col) -> Column:
    """NaN -> NULL (pandas counts and ``value_counts`` skip both)."""
    c = _c(col)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def eq_flag(a, b) -> Column:
    """``if(a = b, 1, 0)``: NULL on either side gives 0."""
    return F.when(_c(a) == _c(b), F.lit(1)).otherwise(F.lit(0))


def row_mean(*cols) -> Column:
    """Mean across columns, skipping NULL/NaN cells (pandas ``mean(axis=1)``).

    NULL when every cell is missing.
    """
    cs = [nan_to_null(_c(c)).cast("double") for c in cols]
    total = F.lit(0.0)
    count = F.lit(0)
    for c in cs:
        total = total + F.coalesce(c, F.lit(0.0))
        count = count + F.when(c.isNull(), 0).otherwise(1)
    return F.try_divide(total, count)
