"""Report formats, as Spark expressions.

FIXED VALUES — text forms used by the report:
  percent : value*100 rounded to 2 places, shortest decimal text, then '%';
            missing value -> 'null'
  change  : like percent with a leading '+' when >= 0; missing -> 'N/A'
  int     : integer part (truncated toward zero)
  f1 / f2 : fixed 1 or 2 decimals (rounded half-up first)
  raw     : shortest decimal text
Missing values print as 'null' in every numeric form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions import col


def percent(x) -> Column:
    x = col(x)
    return F.when(x.isNull(), F.lit("null")).otherwise(
        F.concat(F.round(x * 100, 2).cast("string"), F.lit("%")))


def change(x) -> Column:
    x = col(x)
    v = F.round(x * 100, 2)
    return (F.when(x.isNull(), F.lit("N/A"))
             .when(v >= 0, F.concat(F.lit("+"), v.cast("string"), F.lit("%")))
             .otherwise(F.concat(v.cast("string"), F.lit("%"))))


def fixed(x, places: int) -> Column:
    x = col(x)
    return F.when(x.isNull(), F.lit("null")).otherwise(
        F.format_string(f"%.{places}f", F.round(x, places)))


def integer(x) -> Column:
    x = col(x)
    return F.when(x.isNull(), F.lit("null")).otherwise(x.cast("bigint").cast("string"))


def raw(x) -> Column:
    x = col(x)
    return F.when(x.isNull(), F.lit("null")).otherwise(x.cast("string"))


FORMATS = {"pct": percent, "chg": change, "f1": lambda x: fixed(x, 1),
           "f2": lambda x: fixed(x, 2), "int": integer, "raw": raw}


def by_name(fmt_col, value) -> Column:
    """Format ``value`` with the format named in column ``fmt_col``."""
    fmt_col = col(fmt_col)
    expr = F.lit(None).cast("string")
    for name, fn in FORMATS.items():
        expr = F.when(fmt_col == name, fn(value)).otherwise(expr)
    return expr
