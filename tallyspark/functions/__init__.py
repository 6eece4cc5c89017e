"""Column-level helpers.  Every helper returns a built-in Spark expression, so
plans stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """num / den as double; NULL when den is 0 or either side is NULL
    (ANSI Spark raises on x/0, pandas would give inf/NaN)."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def map_attr(map_col, key: str, dtype: str | None = None) -> Column:
    """Value of ``key`` in a string map; NULL when the key is missing.
    ``dtype`` converts with try_cast, so dirty text becomes NULL instead of
    failing the job under ANSI mode."""
    v = col(map_col)[key]
    return v.try_cast(dtype) if dtype else v


def attr(key: str, dtype: str | None = None) -> Column:
    """Shortcut for the decision log's ``attrs`` map."""
    return map_attr("attrs", key, dtype)


def flag(cond: Column) -> Column:
    """Boolean condition -> 1/0 int (NULL condition counts as 0, like CASE)."""
    return F.when(cond, 1).otherwise(0)


def day(ts) -> Column:
    """Timestamp -> date.  ``to_date(ts) = lit`` is rewritten by Catalyst into
    a pushed range on the raw column (``substr(cast(ts))`` is not)."""
    return F.to_date(col(ts))


def money_sum(c) -> Column:
    """Exact decimal sum (sum of decimal(18,2))."""
    return F.sum(col(c).cast("decimal(18,2)"))


def as_double(c) -> Column:
    return col(c).cast("double")
