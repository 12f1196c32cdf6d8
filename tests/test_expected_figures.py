"""Figures of FIXTURES.md section 3 at sf0.01, and the consistency checks
"""

from pyspark.sql import functions as F

from settlekit.operators import alerts, summaries, trend
import derived_queries as catalog


def _d(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_feed_and_join_counts(ctx01):
    got = _d(catalog.QUERIES["feed_counts"](ctx01), "feed", "rows")
    assert got == {"internal": 14702, "custodian": 14851, "exchange": 14851, "reconciled": 15000}


def test_kpis(ctx01):
    k = summaries.kpis(ctx01.cube).first()
    assert (k.total_trades, k.total_breaks) == (15000, 3145)
    assert round(k.match_rate, 4) == 79.0333
    assert k.total_break_value == 754869433.0


def test_labels_and_types(ctx01):
    types = _d(summaries.type_counts(ctx01.cube), "break_type", "count")
    assert types == {"SETTLEMENT_FAILED": 1639, "QUANTITY_MISMATCH": 596, "PRICE_MISMATCH": 321,
                     "DATE_MISMATCH": 298, "EXCHANGE_QTY_MISMATCH": 298,
                     "COUNTERPARTY_MISMATCH": 291}
    labels = _d(ctx01.recon.groupBy("break_type").count(), "break_type", "count")
    assert labels == {"MATCHED": 11855, "SETTLEMENT_FAILED": 1490, "PRICE_MISMATCH": 321,
                      "QUANTITY_MISMATCH": 298, "DATE_MISMATCH": 298,
                      "COUNTERPARTY_MISMATCH": 291, "EXCHANGE_QTY_MISMATCH": 149,
                      "QUANTITY_MISMATCH | EXCHANGE_QTY_MISMATCH": 149,
                      "QUANTITY_MISMATCH | SETTLEMENT_FAILED": 149}


def test_status_and_aging(ctx01):
    st = _d(ctx01.recon.groupBy("settlement_status").count(), "settlement_status", "count")
    assert st == {"Matched": 11722, "Failed": 1639, "Unmatched": 745, "Partial Match": 447,
                  "Pending": 298, None: 149}
    ag = _d(summaries.aging_summary(ctx01.cube), "aging_bucket", "count")
    # count(trade_id): every row has a key here
    assert ag == {"T+0 to T+1": 3, "T+2 to T+3": 3, "4-7 days": 9, "8-30 days": 38,
                  "31-90 days": 66, "90+ days": 2877, "Unknown": 149}


def test_orphans_without_internal_leg(ctx01):
    r = ctx01.recon.where(F.col("trade_date").isNull())
    assert r.count() == 298
    assert r.where("is_break").count() == 149
    assert r.where("is_break AND break_value <> 0").count() == 0


def test_trade_types_weekday(ctx01):
    tt = {r.trade_type: (r.total_trades, r.breaks)
          for r in summaries.trade_type_summary(ctx01.cube).collect()}
    assert tt == {"1-URGENT": (2923, 551), "2-HIGH": (2946, 619), "3-MEDIUM": (2937, 619),
                  "4-NOT SPECIFIED": (2964, 619), "5-LOW": (2932, 588)}
    wd = summaries.breaks_by_weekday(ctx01.cube).orderBy(F.desc("breaks")).first()
    assert (wd.weekday, wd.breaks) == ("Friday", 468)


def test_daily_stats_and_trend(ctx01):
    s = trend.break_rate_stats(ctx01.daily, ctx01.cfg).first()
    assert s.days == 2399
    assert round(s.mean_rate, 4) == 20.4478 and round(s.std_rate, 4) == 18.1402
    assert trend.break_rate_spikes(ctx01.daily, ctx01.cfg).count() == 80
    ch = trend.daily_trend_change(ctx01.daily).first()
    assert (ch.latest_date, ch.latest_rate, ch.previous_date, ch.previous_rate) == \
        ("2001-08-01", 50.0, "2001-07-31", 25.0)
    assert ch.trend == "increased"


def test_alert_facts(ctx01):
    f = alerts.break_alert_facts(ctx01.cube, ctx01.cfg).first()
    assert (f.high_value_count, f.high_value_total) == (632, 284230442.0)
    assert (f.aged_count, f.aged_value) == (2943, 741205539.0)
    conc = alerts.counterparty_concentration(ctx01.cube, ctx01.cfg).orderBy(F.desc("share_pct"))
    rows = conc.collect()
    assert len(rows) == 8
    assert (rows[0].counterparty, rows[0].breaks) == ("NATION_11", 154)
    assert round(rows[0].share_pct, 4) == 5.1402


def test_summaries_add_up(ctx01):
    """Totals agree across the four summaries, minus the rows without an
    internal leg (they have no counterparty, type or date)."""
    recon = ctx01.recon
    orphan_breaks = recon.where("is_break AND counterparty_int IS NULL").count()
    cs = summaries.counterparty_summary(ctx01.cube).agg(F.sum("total_trades"), F.sum("breaks")).first()
    tt = summaries.trade_type_summary(ctx01.cube).agg(F.sum("total_trades"), F.sum("breaks")).first()
    dd = ctx01.daily.agg(F.sum("total_trades"), F.sum("breaks"), F.sum("break_value")).first()
    ag = summaries.aging_summary(ctx01.cube).agg(F.sum("count"), F.sum("total_value")).first()
    assert tuple(cs) == tuple(tt) == tuple(dd)[:2] == (15000 - 298, 3145 - orphan_breaks)
    assert ag[0] == 3145 and ag[1] == dd[2] == 754869433.0


def test_shares_sum_to_100(ctx01):
    s = summaries.type_distribution(ctx01.cube).agg(F.sum("instance_share_pct")).first()[0]
    assert abs(s - 100.0) < 1e-9
    s = summaries.counterparty_share(ctx01.cube).agg(F.sum("share_pct")).first()[0]
    assert abs(s - 100.0) < 1e-9
