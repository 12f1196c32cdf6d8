"""Numeric helpers that keep results equal to the reference and stable
across engines and partitionings.

* ``half_even`` rounds like NumPy/pandas ``round``: scale, round half to even
  on the binary double, unscale.  Spark's ``round``/``bround`` work on the
  decimal expansion and differ on values such as 0.285 or 17.225.
* ``money`` makes an amount an exact decimal of six places (a value that is
  no number, or too large, becomes NULL); sums of it do not depend on the
  order in which partial sums are combined, and totals may reach 1e32.
* ``pct`` is ``part / whole * 100`` in doubles, NULL when ``whole`` is 0
  (ANSI mode raises on a zero divisor).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(col: Column, digits: int = 0) -> Column:
    if digits == 0:
        return F.rint(col)
    scale = float(10 ** digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def money(col: Column) -> Column:
    """An amount as decimal(38,6)."""
    return col.try_cast("decimal(38,6)")


def amount(total: Column) -> Column:
    """A decimal total as double; 0.0 over no rows (like pandas' sum)."""
    return F.coalesce(total.cast("double"), F.lit(0.0))


def pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def count_true(col: Column) -> Column:
    """Number of rows where a boolean column is true, as bigint (0 over no rows)."""
    return F.coalesce(F.sum(F.when(col, F.lit(1)).otherwise(F.lit(0))).cast("bigint"),
                      F.lit(0).cast("bigint"))
