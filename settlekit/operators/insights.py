"""Insight tables (I1-I4, I10-I13) and the knowledge-base document.

The reference renders these as prose; here they are fact tables whose
numbers are computed by Spark and whose text columns are assembled with
``concat``/``format_number``.  The wording is ours; the figures, labels and
orderings are the contract.

Each composite table is a projection of the fact vector (``facts``): one
aggregation of the break cube, no join of aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ReconConfig
from ..functions import labels as L
from ..functions.numeric import half_even, pct
from . import facts
from . import summaries as S

#: fixed values: resolution priority by break label
PRIORITIES = ((L.QUANTITY_MISMATCH, "HIGH"), (L.PRICE_MISMATCH, "MEDIUM"), (L.COUNTERPARTY_MISMATCH, "MEDIUM"),
              (L.DATE_MISMATCH, "LOW"), (L.SETTLEMENT_FAILED, "HIGH"), (L.EXCHANGE_QTY_MISMATCH, None))


def root_cause_by_type(cube: DataFrame, cfg: ReconConfig, remediation: DataFrame | None = None) -> DataFrame:
    """I2 + I4: label, count, share of instances, cause, action, priority.

    ``remediation`` (break_type, priority, root_cause, action) is the user's
    table of causes and actions, one row per label; without it the shipped
    priorities stand alone."""
    row = facts.vector(cube, cfg)
    rows = row.select("instances", F.explode("types").alias("t")).select(
        F.col("t.key").alias("break_type"), facts.display(F.col("t.key")).alias("display_name"),
        F.col("t.count").alias("count"), half_even(facts.share(F.col("t.count")), 1).alias("share_pct"))
    if remediation is not None:
        return rows.join(remediation, "break_type", "left").select(*rows.columns, "root_cause", "action", "priority")
    priority = F.coalesce(*[F.when(F.col("break_type") == label, F.lit(p)) for label, p in PRIORITIES if p is not None])
    return rows.select("*", F.lit(None).cast("string").alias("root_cause"), F.lit(None).cast("string").alias("action"),
                       priority.alias("priority"))


def daily_summary_facts(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Headline KPIs, day-over-day change, worst counterparty, top label."""
    worst, change = facts.summary_counterparty(facts.top("cps")), facts.trend()
    return facts.vector(cube, cfg).withColumns({"worst": F.when(F.size("cps") > 0, worst), "change": change}).select(
        F.col("trades").alias("total_trades"), F.col("breaks").alias("total_breaks"),
        half_even(facts.match_rate(), 1).alias("match_rate"), F.col("value").alias("total_break_value"),
        *[F.col(f"change.{c}").alias(c) for c in ("latest_date", "latest_rate", "previous_date", "previous_rate", "trend")],
        F.col("worst.counterparty").alias("top_counterparty"), F.col("worst.breaks").alias("top_counterparty_breaks"),
        F.col("worst.total_break_value").alias("top_counterparty_value"),
        F.substring_index(facts.top("patterns")["key"], L.LABEL_SEPARATOR, 1).alias("top_break_type"))


def pattern_facts(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Top-3 counterparty concentration, modal trade type, peak weekday."""
    top3 = F.filter(facts.top("cps", 3), lambda s: s["breaks"] > 0)
    held = F.aggregate("top3", F.lit(0).cast("bigint"), lambda acc, s: acc + s["breaks"])
    return facts.vector(cube, cfg).withColumns({
        "top3": top3, "kind": facts.top("trade_types"), "peak": facts.top("weekdays")}).select(
        F.array_join(F.transform("top3", lambda s: s["key"]), ", ").alias("top3_counterparties"),
        F.when(F.size("top3") > 0, pct(held, F.col("breaks"))).alias("top3_share_pct"),
        F.col("kind.key").alias("modal_trade_type"), F.col("kind.breaks").alias("modal_trade_type_breaks"),
        F.col("peak.key").alias("peak_weekday"), F.col("peak.breaks").alias("peak_weekday_breaks"))


# --- knowledge base --------------------------------------------------------

def kb_overview(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """I10."""
    return S.kpis(cube).select(
        "total_trades", "total_breaks", half_even(F.col("match_rate"), 1).alias("match_rate"),
        half_even(F.col("total_break_value"), 2).alias("total_break_value"),
        F.lit(cfg.effective_report_date.isoformat()).alias("report_date"))


def kb_break_types(cube: DataFrame) -> DataFrame:
    """Lower-case label -> count and share (1 dp)."""
    return S.type_distribution(cube).select(
        F.lower("break_type").alias("break_type"), "count",
        half_even(F.col("instance_share_pct"), 1).alias("percentage"))


def kb_top_counterparties(cs: DataFrame, k: int = 5) -> DataFrame:
    """The counterparty summary's top five by breaks."""
    return (cs.orderBy(F.desc("breaks"), F.asc("counterparty_int")).limit(k)
            .select(F.col("counterparty_int").alias("counterparty"), "total_trades", "breaks",
                    half_even(F.col("match_rate"), 1).alias("match_rate"),
                    half_even(F.col("total_break_value"), 0).alias("break_value")))


def kb_faq(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Six rows, each a question key and the figures that answer it."""
    row = facts.vector(cube, cfg).withColumn("alerts", facts.alert_array(cfg))
    return row.select(F.inline(facts.faq_array(cfg)))


def kb_document(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """The whole knowledge base as one JSON document (one row).

    Numbers are written as decimals at their rounding scale (rates and
    shares 1 dp, money 2 dp / 0 dp), so the text is plain fixed-point and
    independent of how a JSON writer prints doubles."""
    overview = F.struct(
        F.col("trades").alias("total_trades"), F.col("breaks").alias("total_breaks"),
        half_even(facts.match_rate(), 1).cast("decimal(6,1)").alias("match_rate"),
        half_even(F.col("value"), 2).cast("decimal(20,2)").alias("total_break_value"),
        F.lit(cfg.effective_report_date.isoformat()).alias("report_date"))
    entry = lambda key, value: F.struct(key.alias("key"), value.alias("value"))
    types = F.map_from_entries(F.transform("types", lambda t: entry(F.lower(t["key"]), F.struct(
        t["count"].alias("count"), half_even(facts.share(t["count"]), 1).cast("decimal(6,1)").alias("percentage")))))

    def counterparty(s: Column) -> Column:
        row = facts.summary_counterparty(s)
        return entry(s["key"], F.struct(
            row["total_trades"].alias("total_trades"), row["breaks"].alias("breaks"),
            half_even(row["match_rate"], 1).cast("decimal(6,1)").alias("match_rate"),
            half_even(row["total_break_value"], 0).cast("decimal(20,0)").alias("break_value")))
    worst = F.map_from_entries(F.transform(facts.top("cps", 5), counterparty))
    faq = F.transform(facts.faq_array(cfg), lambda r: F.struct(r["question"].alias("question"), r["answer"].alias("answer")))
    row = facts.vector(cube, cfg).withColumn("alerts", facts.alert_array(cfg))
    return row.select(F.to_json(F.struct(
        overview.alias("overview"), types.alias("break_types"), worst.alias("counterparty_breaks"),
        faq.alias("faq_pairs"))).alias("kb_json"))
