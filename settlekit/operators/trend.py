"""Day-over-day change and break-rate statistics on the daily table.

Everything here runs on the *aggregated* daily table (one row per trading
day), never on trade rows, so the global ordering and the statistics work on
a table bounded by the number of calendar days.  Like the reference, the
statistics use the daily rates already rounded to 2 dp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ReconConfig
from ..functions import labels as L


def daily_trend_change(daily: DataFrame) -> DataFrame:
    """Latest day against the previous one (the latest itself when only
    one day exists); no row when the daily table is empty."""
    last2 = daily.orderBy(F.desc("trade_date_str")).limit(2)
    agg = last2.agg(
        F.max_by(F.struct("trade_date_str", "break_rate"), F.col("trade_date_str")).alias("l"),
        F.min_by(F.struct("trade_date_str", "break_rate"), F.col("trade_date_str")).alias("p"),
        F.count(F.lit(1)).alias("n"),
    ).where(F.col("n") > 0)
    change = F.col("l.break_rate") - F.col("p.break_rate")
    return agg.select(
        F.col("l.trade_date_str").alias("latest_date"),
        F.col("l.break_rate").alias("latest_rate"),
        F.col("p.trade_date_str").alias("previous_date"),
        F.col("p.break_rate").alias("previous_rate"),
        change.alias("rate_change"),
        F.when(change > 0, F.lit(L.TREND_UP)).when(change < 0, F.lit(L.TREND_DOWN))
        .otherwise(F.lit(L.TREND_FLAT)).alias("trend"),
    )


def break_rate_stats(daily: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Mean, sample std and the spike threshold mean + sigma * std.

    The rates carry two decimals, so their sum and sum of squares are exact
    in decimal arithmetic; mean and sample variance are then formed from
    those exact sums.  The result does not depend on how partial
    aggregates are combined (a double-based avg/stddev would, in the last
    bits), and there is no cancellation error.  One day -> NULL std (no
    spikes), like the n-1 estimator in the reference."""
    x = F.col("break_rate").cast("decimal(12,2)")
    agg = daily.agg(F.count(F.lit(1)).alias("days"), F.sum(x).alias("sx"),
                    F.sum(x * x).alias("sxx"))
    n = F.col("days")
    var_num = (n * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
    return agg.select(
        "days",
        (F.col("sx").cast("double") / n.cast("double")).alias("mean_rate"),
        F.when(n > 1, F.sqrt(var_num / (n * (n - 1)).cast("double"))).alias("std_rate"),
    ).withColumn("threshold", F.col("mean_rate") + F.lit(float(cfg.sigma)) * F.col("std_rate"))


def break_rate_spikes(daily: DataFrame, cfg: ReconConfig) -> DataFrame:
    """I5 rows: every day whose rate is above the threshold.

    The threshold is a scalar subquery (evaluated once, planned as a
    literal), not a join of the stats row onto every day."""
    stats = break_rate_stats(daily, cfg)
    s = stats.select(F.struct("threshold", "mean_rate")).scalar()
    return (daily.where(F.col("break_rate") > s["threshold"])
            .select("trade_date_str", "break_rate", s["threshold"].alias("threshold"),
                    s["mean_rate"].alias("mean_rate")))
