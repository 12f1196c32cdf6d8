"""Rule-based anomaly alerts (I5-I9) and their union.

The three break-level rules (high value, aged, failed) are conditional
counts computed in the break cube's single pass.  The alert table itself is
tiny and bounded (at most one row per rule, plus at most
floor(100 / concentration_pct) concentration rows: no more counterparties
than that can each hold more than that share) and is an array of the fact
vector.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ReconConfig
from ..functions import labels as L
from . import facts, summaries
from .cube import totals

ALERT_COLUMNS = ("alert_rank", "severity", "alert_type", "message", "dates",
                 "counterparty", "alert_count")


def break_alert_facts(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """High-value, aged and failed counts/values over the breaks (already
    computed in the cube's single pass)."""
    t = totals(cube)
    return t.agg(
        F.coalesce(F.sum("high_value_count"), F.lit(0)).cast("bigint").alias("high_value_count"),
        F.coalesce(F.sum("high_value_total"), F.lit(0.0)).alias("high_value_total"),
        F.coalesce(F.sum("aged_count"), F.lit(0)).cast("bigint").alias("aged_count"),
        F.coalesce(F.sum("aged_value"), F.lit(0.0)).alias("aged_value"),
        F.coalesce(F.sum("failed_count"), F.lit(0)).cast("bigint").alias("failed_count"),
    )


def high_value_breaks(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    return break_alert_facts(cube, cfg).select(
        "high_value_count", F.coalesce("high_value_total", F.lit(0.0)).alias("high_value_total"),
        F.lit(float(cfg.high_value)).alias("threshold"))


def aged_breaks(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    return break_alert_facts(cube, cfg).select(
        "aged_count", F.coalesce("aged_value", F.lit(0.0)).alias("aged_value"))


def failed_settlements(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    return break_alert_facts(cube, cfg).select(
        "failed_count", (F.col("failed_count") > F.lit(cfg.failed_min)).alias("alert_fires"))


def counterparty_concentration(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Counterparties above the single-counterparty share limit."""
    return (summaries.counterparty_share(cube)
            .where(F.col("share_pct") > F.lit(float(cfg.concentration_pct))))


def anomaly_alerts(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """The fired alerts in rule order, ranked 1..n (``facts.alert_array``)."""
    return facts.vector(cube, cfg).select(F.inline(facts.alert_array(cfg))).select(*ALERT_COLUMNS)
