"""One-key summaries (A1-A16), read from the break cube.

Every summary is a slice of ``operators.cube.break_cube`` -- one
grouping-sets pass over the reconciled rows -- so none of them scans the
rows again.  NULL group keys are left out where the reference's pandas
``groupby``/``value_counts`` drop them; groups without breaks are left out
where the reference only grouped the breaks.

Ties are broken by the key ascending wherever a limit follows a sort, so
the top-k results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import labels as L
from ..functions.numeric import half_even, pct
from .aging import bucket_ordinal
from .cube import slice_, totals


def breaks_only(recon: DataFrame) -> DataFrame:
    return recon.where(F.col("is_break"))


def _sum0(c: str):
    return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")


def kpis(cube: DataFrame) -> DataFrame:
    """A1 + A14: one row of overall figures (also over no trades)."""
    agg = totals(cube).agg(
        _sum0("rows").alias("total_trades"), _sum0("breaks").alias("total_breaks"),
        F.coalesce(F.sum("value"), F.lit(0.0)).alias("total_break_value"))
    return agg.select(
        "total_trades", "total_breaks",
        (F.col("total_trades") - F.col("total_breaks")).alias("matched_trades"),
        pct(F.col("total_trades") - F.col("total_breaks"), F.col("total_trades")).alias("match_rate"),
        "total_break_value",
        F.try_divide(F.col("total_break_value"), F.col("total_breaks").cast("double"))
        .alias("avg_break_value"),
    )


def type_counts(cube: DataFrame) -> DataFrame:
    """A2: (break_type, count) per single label over all breaks.

    The flags already say which labels a row carries, so the cube's six
    flag counts are the instance counts; unpivot them -- no explode of the
    rows and no string splitting."""
    stacked = ", ".join(f"'{label}', n_{name}" for name, label in L.CHECKS)
    return (totals(cube).selectExpr(f"stack({len(L.CHECKS)}, {stacked}) AS (break_type, count)")
            .where(F.col("count") > 0))


def type_distribution(cube: DataFrame) -> DataFrame:
    """A2 with the share of all break instances (not of trades)."""
    counts = type_counts(cube)
    total = counts.agg(F.sum("count").alias("t")).scalar()
    return counts.select("break_type", "count",
                         pct(F.col("count"), total).alias("instance_share_pct"))


def _with_breaks(cube: DataFrame, dim: str) -> DataFrame:
    return slice_(cube, dim).where(F.col("key").isNotNull() & (F.col("breaks") > 0))


def top_counterparties(cube: DataFrame, k: int = 10) -> DataFrame:
    """A3: counterparties with the most breaks (count and value)."""
    return (_with_breaks(cube, "counterparty")
            .select(F.col("key").alias("counterparty"), F.col("breaks").alias("break_count"),
                    F.col("value").alias("break_value"))
            .orderBy(F.desc("break_count"), F.asc("counterparty")).limit(k))


def aging_distribution(cube: DataFrame) -> DataFrame:
    """A4: break counts per aging bucket in display order, Unknown left out."""
    return (_with_breaks(cube, "aging").where(F.col("key") != F.lit(L.AGING_UNKNOWN))
            .select(bucket_ordinal(F.col("key")).alias("display_order"),
                    F.col("key").alias("aging_bucket"), F.col("breaks").alias("count")))


def status_distribution(cube: DataFrame) -> DataFrame:
    """A5: settlement status counts; share of all reconciled rows."""
    total = totals(cube).select("rows").scalar()
    return (slice_(cube, "status").where(F.col("key").isNotNull())
            .select(F.col("key").alias("settlement_status"), F.col("rows").alias("count"),
                    pct(F.col("rows"), total).alias("share_pct")))


def _break_summary(cube: DataFrame, dim: str, key: str) -> DataFrame:
    """count(trade_id), breaks, match rate and break value, 1 dp."""
    return (slice_(cube, dim).where(F.col("key").isNotNull())
            .select(F.col("key").alias(key), F.col("keyed_rows").alias("total_trades"), "breaks",
                    half_even((F.lit(1.0) - F.col("breaks").cast("double") / F.col("rows").cast("double"))
                              * F.lit(100.0), 1).alias("match_rate"),
                    half_even(F.col("value"), 1).alias("total_break_value")))


def counterparty_summary(cube: DataFrame) -> DataFrame:
    return _break_summary(cube, "counterparty", "counterparty_int")


def trade_type_summary(cube: DataFrame) -> DataFrame:
    return _break_summary(cube, "trade_type", "trade_type")


def daily_break_trend(cube: DataFrame) -> DataFrame:
    """Per trade day; the rate is rounded to 2 dp, the value is not."""
    return (slice_(cube, "day").where(F.col("key").isNotNull())
            .select(F.col("key").alias("trade_date_str"), F.col("keyed_rows").alias("total_trades"),
                    "breaks", F.col("value").alias("break_value"),
                    half_even(F.col("breaks").cast("double") / F.col("keyed_rows").cast("double")
                              * F.lit(100.0), 2).alias("break_rate")))


def aging_summary(cube: DataFrame) -> DataFrame:
    """Breaks per aging bucket (Unknown included); value to 0 dp."""
    return (slice_(cube, "aging").where(F.col("breaks") > 0)
            .select(F.col("key").alias("aging_bucket"), F.col("keyed_breaks").alias("count"),
                    half_even(F.col("value"), 0).alias("total_value")))


def label_counts(cube: DataFrame) -> DataFrame:
    """Whole-label counts over breaks (the input of A10)."""
    return _with_breaks(cube, "label").select(F.col("key").alias("break_type"),
                                              F.col("breaks").alias("count"))


def modal_break_pattern(cube: DataFrame) -> DataFrame:
    """A10: the most frequent whole label and its first part."""
    return (label_counts(cube).orderBy(F.desc("count"), F.asc("break_type")).limit(1)
            .select(F.col("break_type").alias("modal_label"), F.col("count").alias("label_count"),
                    F.substring_index("break_type", L.LABEL_SEPARATOR, 1).alias("top_break")))


def counterparty_break_counts(cube: DataFrame) -> DataFrame:
    return _with_breaks(cube, "counterparty").select(F.col("key").alias("counterparty"), "breaks")


def top3_concentration(cube: DataFrame) -> DataFrame:
    """Share of all breaks held by the three counterparties with the
    most breaks (breaks without a counterparty count in the denominator)."""
    total = totals(cube).select("breaks").scalar()
    top3 = counterparty_break_counts(cube).orderBy(F.desc("breaks"), F.asc("counterparty")).limit(3)
    return top3.agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            (-F.col("breaks")).alias("nb"), F.col("counterparty").alias("cp")))), lambda s: s["cp"]),
            ", ").alias("top3_counterparties"),
        F.sum("breaks").cast("bigint").alias("top3_breaks"),
    ).select("top3_counterparties", "top3_breaks", total.alias("total_breaks"),
             pct(F.col("top3_breaks"), total).alias("top3_share_pct"))


def modal_trade_type(cube: DataFrame) -> DataFrame:
    """Trade type with the most breaks."""
    return (_with_breaks(cube, "trade_type").select(F.col("key").alias("trade_type"), "breaks")
            .orderBy(F.desc("breaks"), F.asc("trade_type")).limit(1))


def breaks_by_weekday(cube: DataFrame) -> DataFrame:
    """Breaks per weekday name of the trade date."""
    return _with_breaks(cube, "weekday").select(F.col("key").alias("weekday"), "breaks")


def counterparty_share(cube: DataFrame) -> DataFrame:
    """Each counterparty's share of the breaks that have one."""
    counts = counterparty_break_counts(cube)
    total = counts.agg(F.sum("breaks")).scalar()
    return counts.select("counterparty", "breaks", pct(F.col("breaks"), total).alias("share_pct"))


def feed_counts(cube: DataFrame) -> DataFrame:
    """S3: rows per feed and after the join.  Every row of a feed is in exactly
    one joined row, so the cube has counted them and no feed is read again."""
    names = [*schemas.LEGS, "reconciled"]
    return totals(cube).agg(*[_sum0(f"{n}_rows" if n in schemas.LEGS else "rows").alias(n) for n in names]).selectExpr(
        f"stack({len(names)}, " + ", ".join(f"'{n}', {n}" for n in names) + ") AS (feed, rows)")
