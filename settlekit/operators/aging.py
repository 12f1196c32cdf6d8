"""Break aging (C10-C12): days since the trade date and the bucket label.

The bucket is computed for every row, not only for breaks, like the
reference.  A missing or unparsable trade date gives ``Unknown``; a trade
date after ``as_of`` gives a negative age, which falls in the first bucket.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import labels as L


def parse_date_expr(col: str, dtype: T.DataType) -> str:
    """Tolerant date parse: dates pass through, strings go through
    ``try_to_date`` (NULL instead of an ANSI error), timestamps are cast."""
    if isinstance(dtype, T.DateType):
        return col
    if isinstance(dtype, T.StringType):
        return f"try_to_date({col})"
    return f"CAST({col} AS DATE)"


def bucket_expr(days: str) -> str:
    whens = " ".join(f"WHEN {days} <= {upper} THEN '{label}'" for label, upper in L.AGING_BOUNDS)
    return f"CASE WHEN {days} IS NULL THEN '{L.AGING_UNKNOWN}' {whens} ELSE '{L.AGING_90_PLUS}' END"


def bucket_ordinal(bucket: Column) -> Column:
    """Display position of a bucket (1-based), NULL for Unknown."""
    expr = None
    for pos, label in enumerate(L.AGING_DISPLAY_ORDER, start=1):
        cond = bucket == F.lit(label)
        expr = F.when(cond, F.lit(pos)) if expr is None else expr.when(cond, F.lit(pos))
    return expr


def add_aging(df: DataFrame, as_of: _dt.date) -> DataFrame:
    parsed = parse_date_expr("trade_date", df.schema["trade_date"].dataType)
    return (df.selectExpr("*", f"{parsed} AS trade_date_dt")
            .selectExpr("*", f"datediff(DATE '{as_of.isoformat()}', trade_date_dt) AS days_outstanding")
            .selectExpr("*", f"{bucket_expr('days_outstanding')} AS aging_bucket"))
