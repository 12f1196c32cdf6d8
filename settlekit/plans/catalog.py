"""The report queries: name -> function of a ``ReconContext``.

Every query covers the whole reconciled table.  Limits appear only where the
top-k is the feature (top counterparties, modal values).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .. import schemas
from ..operators import alerts, breaks, insights, reconcile, summaries, trend
from .context import ReconContext


def _break_flags(ctx: ReconContext) -> DataFrame:
    return ctx.recon.select("trade_id", *breaks.FLAG_COLUMNS, "break_type", "is_break",
                            "break_value")


def _break_aging(ctx: ReconContext) -> DataFrame:
    return ctx.recon.select("trade_id", "trade_date_dt", "days_outstanding", "aging_bucket")


QUERIES: dict[str, Callable[[ReconContext], DataFrame]] = {
    # sources / row layer
    "feed_counts": lambda c: summaries.feed_counts(c.cube),
    "internal_vs_custodian": lambda c: reconcile.internal_vs_custodian(c.feeds),
    "three_way_recon": lambda c: c.recon.select(*schemas.JOINED_COLUMNS),
    "break_flags": _break_flags,
    "break_aging": _break_aging,
    "reconciliation_report": lambda c: c.report,
    "settlement_breaks": lambda c: c.settlement_breaks,
    # one-key summaries
    "recon_kpis": lambda c: summaries.kpis(c.cube),
    "break_type_distribution": lambda c: summaries.type_distribution(c.cube),
    "top_counterparties": lambda c: summaries.top_counterparties(c.cube),
    "aging_distribution": lambda c: summaries.aging_distribution(c.cube),
    "status_distribution": lambda c: summaries.status_distribution(c.cube),
    "counterparty_summary": lambda c: c.counterparty_summary,
    "trade_type_summary": lambda c: summaries.trade_type_summary(c.cube),
    "daily_break_trend": lambda c: c.daily,
    "aging_summary": lambda c: summaries.aging_summary(c.cube),
    # patterns
    "modal_break_pattern": lambda c: summaries.modal_break_pattern(c.cube),
    "top3_concentration": lambda c: summaries.top3_concentration(c.cube),
    "modal_trade_type": lambda c: summaries.modal_trade_type(c.cube),
    "breaks_by_weekday": lambda c: summaries.breaks_by_weekday(c.cube),
    "pattern_facts": lambda c: insights.pattern_facts(c.cube, c.cfg),
    "daily_trend_change": lambda c: trend.daily_trend_change(c.daily),
    "break_rate_stats": lambda c: trend.break_rate_stats(c.daily, c.cfg),
    # alerts
    "break_rate_spikes": lambda c: trend.break_rate_spikes(c.daily, c.cfg),
    "counterparty_concentration": lambda c: alerts.counterparty_concentration(c.cube, c.cfg),
    "high_value_breaks": lambda c: alerts.high_value_breaks(c.cube, c.cfg),
    "aged_breaks": lambda c: alerts.aged_breaks(c.cube, c.cfg),
    "failed_settlements": lambda c: alerts.failed_settlements(c.cube, c.cfg),
    "anomaly_alerts": lambda c: alerts.anomaly_alerts(c.cube, c.cfg),
    # insight tables and knowledge base
    "daily_summary_facts": lambda c: insights.daily_summary_facts(c.cube, c.cfg),
    "root_cause_by_type": lambda c: insights.root_cause_by_type(c.cube, c.cfg),
    "kb_overview": lambda c: insights.kb_overview(c.cube, c.cfg),
    "kb_break_types": lambda c: insights.kb_break_types(c.cube),
    "kb_top_counterparties": lambda c: insights.kb_top_counterparties(c.counterparty_summary),
    "kb_faq": lambda c: insights.kb_faq(c.cube, c.cfg),
    "kb_document": lambda c: insights.kb_document(c.cube, c.cfg),
}
