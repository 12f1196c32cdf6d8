"""The break cube: every small aggregate of a run in one pass.

All summaries, alerts and insight tables of the reference are one-key
counts and sums over the reconciled rows (by counterparty, trade type, day,
aging bucket, label, weekday, status, or over everything).  Instead of one
scan and one shuffle per summary, ``row_aggregates`` computes them with one
``GROUPING SETS`` aggregation: Spark expands each row once per grouping set
inside the same whole-stage-codegen pipeline and aggregates partially on the
map side, so a hot key is a few rows per task.  Each row is expanded for three
sets only, (counterparty), (day) and (trade type, label, status); the slices
of the last three and of everything are added up from the third, whose groups
are few (counts and decimal sums add up exactly).  Its result is written, and
``break_cube`` works on the written rows only: aging bucket and weekday are
functions of the trade date, so their slices are re-aggregated from the day
slice (exact: money stays decimal until the end).

The result is bounded by the sizes of the dimensions (days + counterparties
+ labels + ...), independent of the number of trades, so persisting it is
always cheap.  Every downstream table reads this cube.

Columns: ``dim`` (which grouping: all, counterparty, trade_type, day,
aging, label, weekday, status), ``key`` (the group value, NULL for the
group of NULL values and for ``all``) and the measures below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..config import ReconConfig
from ..functions import labels as L
from ..functions.numeric import amount, count_true, money
from .aging import bucket_expr

DIMENSIONS = ("counterparty", "trade_type", "day", "aging", "label", "weekday", "status")
# aggregated per row; "aging" and "weekday" are functions of the trade date,
# so their slices are re-aggregated from the (bounded) day slice instead of
# expanding every row two more times
ROW_DIMENSIONS = ("counterparty", "trade_type", "day", "label", "status")
# the sets every row is expanded for, and the dimensions added up from the last
ROW_SETS = (("counterparty",), ("day",), ("trade_type", "label", "status"))
ALL = "all"

_COUNTS = ("rows", "keyed_rows", "breaks", "keyed_breaks",
           *[f"n_{name}" for name, _ in L.CHECKS], "high_value_count", "aged_count", "failed_count",
           *[f"{feed}_rows" for feed in schemas.LEGS])
_SUMS = ("value_sum", "high_value_sum", "aged_value_sum")


def row_aggregates(recon: DataFrame, cfg: ReconConfig, also: str | None = None) -> DataFrame:
    """The one-pass aggregation; with ``also``, per value of that column too
    (``merged`` adds these up)."""
    is_break = F.col("is_break")
    high = is_break & (F.col("break_value") > F.lit(float(cfg.high_value)))
    aged = is_break & F.col("aging_bucket").isin(*L.AGED_BUCKETS)
    failed = is_break & F.coalesce(F.col("break_type").contains(L.FAILED_MARKER), F.lit(False))
    kept = [also] if also else []
    rows = recon.select(
        *kept, F.col("counterparty_int").alias("counterparty"),
        "trade_type",
        F.col("trade_date_dt").alias("day"),
        F.col("break_type").alias("label"),
        F.col("settlement_status").alias("status"),
        "trade_id", "is_break", "break_value",
        *[f"flag_{name}" for name, _ in L.CHECKS], *[f"has_{leg}" for leg in schemas.LEGS.values()],
        high.alias("_high"), aged.alias("_aged"), failed.alias("_failed"),
        # amounts as decimals before a row is expanded; other rows' value is 0
        F.when(is_break, money(F.col("break_value"))).alias("_value"),
    )
    parts = rows.groupingSets([[*s, *kept] for s in ROW_SETS], *ROW_DIMENSIONS, *kept).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("trade_id").alias("keyed_rows"),
        count_true(is_break).alias("breaks"),
        count_true(is_break & F.col("trade_id").isNotNull()).alias("keyed_breaks"),
        *[count_true(F.col(f"flag_{name}")).alias(f"n_{name}") for name, _ in L.CHECKS],
        count_true(F.col("_high")).alias("high_value_count"),
        count_true(F.col("_aged")).alias("aged_count"),
        count_true(F.col("_failed")).alias("failed_count"),
        *[count_true(F.col(f"has_{leg}")).alias(f"{feed}_rows") for feed, leg in schemas.LEGS.items()],
        F.sum("_value").alias("value_sum"),
        F.sum(F.when(F.col("_high"), F.col("_value"))).alias("high_value_sum"),
        F.sum(F.when(F.col("_aged"), F.col("_value"))).alias("aged_value_sum"),
        *[F.grouping(d).alias(f"g_{d}") for d in ROW_DIMENSIONS],
    )
    # per group the dimensions it counts for: its own, or each of the last set and none
    own = F.when(F.col("g_counterparty") == 0, F.array(F.lit("counterparty"))).when(
        F.col("g_day") == 0, F.array(F.lit("day"))).otherwise(F.array(*[F.lit(d) for d in (*ROW_SETS[-1], ALL)]))
    values = [*_COUNTS, *_SUMS]
    spread = parts.select(*ROW_DIMENSIONS, *kept, *values, F.explode(own).alias("_dim"))
    spread = spread.select(*[F.when(F.col("_dim") == d, F.col(d)).alias(d) for d in ROW_DIMENSIONS], *kept, *values,
                           *[(F.col("_dim") != d).cast("byte").alias(f"g_{d}") for d in ROW_DIMENSIONS])
    grouped = [f"g_{d}" for d in ROW_DIMENSIONS]
    return spread.groupBy(*ROW_DIMENSIONS, *kept, *grouped).agg(*[F.sum(v).alias(v) for v in values]).select(
        *ROW_DIMENSIONS, *kept, *values, *grouped)


def measures(also: str) -> T.StructType:
    """The schema of ``row_aggregates`` per date column ``also``."""
    kinds = ([(d, T.DateType() if d == "day" else T.StringType()) for d in ROW_DIMENSIONS]
             + [(c, T.LongType()) for c in _COUNTS] + [(c, T.DecimalType(38, 6)) for c in _SUMS]
             + [(f"g_{d}", T.ByteType()) for d in ROW_DIMENSIONS] + [(also, T.DateType())])
    return T.StructType([T.StructField(n, t) for n, t in kinds])


def merged(parts: DataFrame) -> DataFrame:
    """The aggregates of all parts of the rows from those of each: counts and
    decimal sums add up exactly."""
    keys = [*ROW_DIMENSIONS, *[f"g_{d}" for d in ROW_DIMENSIONS]]
    sums = parts.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in (*_COUNTS, *_SUMS)])
    return sums.select(*ROW_DIMENSIONS, *_COUNTS, *_SUMS, *[f"g_{d}" for d in ROW_DIMENSIONS])


def break_cube(agg: DataFrame, cfg: ReconConfig) -> DataFrame:
    """The cube from the written rows of ``row_aggregates``."""
    dim = F.lit(ALL)
    key = F.lit(None).cast("string")
    for d in reversed(ROW_DIMENSIONS):
        dim = F.when(F.col(f"g_{d}") == 0, F.lit(d)).otherwise(dim)
        value = F.date_format(F.col(d), "yyyy-MM-dd") if d == "day" else F.col(d)
        key = F.when(F.col(f"g_{d}") == 0, value).otherwise(key)
    values = [*_COUNTS, *_SUMS]
    per_row = agg.select(dim.alias("dim"), key.alias("key"), F.col("day").alias("_day"), *values)

    # aging bucket and weekday from the day slice (one row per trade date)
    days = per_row.where(F.col("dim") == F.lit("day"))
    age = F.datediff(F.lit(cfg.as_of), F.col("_day"))
    derived = [
        days.withColumn("_age", age).select(
            F.lit("aging").alias("dim"), F.expr(bucket_expr("_age")).alias("key"), *values),
        days.select(F.lit("weekday").alias("dim"), F.date_format("_day", "EEEE").alias("key"),
                    *values),
    ]
    sums = [F.sum(m).alias(m) for m in values]
    out = per_row.drop("_day")
    for d in derived:
        out = out.unionByName(d.groupBy("dim", "key").agg(*sums))
    dbl = lambda c: amount(F.col(c))
    return out.select(
        "dim", "key", *[F.col(c).cast("bigint").alias(c) for c in _COUNTS[:4]],
        dbl("value_sum").alias("value"),
        *[F.col(f"n_{name}").cast("bigint").alias(f"n_{name}") for name, _ in L.CHECKS],
        F.col("high_value_count").cast("bigint").alias("high_value_count"),
        dbl("high_value_sum").alias("high_value_total"),
        F.col("aged_count").cast("bigint").alias("aged_count"),
        dbl("aged_value_sum").alias("aged_value"),
        F.col("failed_count").cast("bigint").alias("failed_count"),
        *[F.col(f"{feed}_rows").cast("bigint").alias(f"{feed}_rows") for feed in schemas.LEGS],
    )


def slice_(cube: DataFrame, dim: str) -> DataFrame:
    """The groups of one dimension (``key`` may be NULL: the NULL group)."""
    return cube.where(F.col("dim") == F.lit(dim))


def totals(cube: DataFrame) -> DataFrame:
    """The single ``all`` row."""
    return slice_(cube, ALL)
