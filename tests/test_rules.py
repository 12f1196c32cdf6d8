
import datetime as dt
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import D0, custodian_row, exchange_row, internal_row, make_feeds
from settlekit import schemas
from settlekit.config import ReconConfig
from settlekit.functions.numeric import half_even
from settlekit.operators import alerts, summaries, trend
from settlekit.operators.aging import bucket_expr
from settlekit.plans.context import ReconContext

CFG = ReconConfig(as_of=dt.date(2025, 12, 31))


def _ctx(spark, cfg=CFG, strategy="keys", **feeds):
    return ReconContext(spark, make_feeds(spark, **feeds), cfg.with_(strategy=strategy))


def _recon(spark, cfg=CFG, strategy="keys", **feeds):
    return _ctx(spark, cfg, strategy, **feeds).recon


def _by_id(df):
    return {r.trade_id: r for r in df.collect()}


def test_missing_leg_is_not_a_break(spark):
    r = _by_id(_recon(spark, internal=[internal_row("A"), internal_row("B")],
                      custodian=[custodian_row("A")], exchange=[exchange_row("B")]))
    assert r["A"].break_type == "MATCHED" and r["B"].break_type == "MATCHED"
    assert r["A"].quantity_exch is None and r["B"].quantity_cust is None


def test_orphan_failed_custodian_row(spark):
    r = _by_id(_recon(spark, custodian=[custodian_row("X", status="Failed"),
                                        custodian_row("Y", status="Matched")]))
    assert r["X"].break_type == "SETTLEMENT_FAILED" and r["X"].is_break
    assert r["X"].break_value == 0.0 and r["X"].aging_bucket == "Unknown"
    assert r["X"].counterparty_int is None and r["X"].trade_type is None
    assert r["Y"].break_type == "MATCHED"


def test_price_tolerance_in_doubles(spark):
    r = _by_id(_recon(spark,
                      internal=[internal_row("P1", price=100.01), internal_row("P2", price=10.01)],
                      custodian=[custodian_row("P1", price=100.0), custodian_row("P2", price=10.0)]))
    assert r["P1"].break_type == "PRICE_MISMATCH"      # 0.010000000000005116 > 0.01
    assert r["P2"].break_type == "MATCHED"             # 0.009999999999999787


def test_all_six_labels_in_check_order(spark):
    r = _by_id(_recon(spark,
                      internal=[internal_row("Z", qty=100, price=10.0, cp="CP-A")],
                      custodian=[custodian_row("Z", qty=200, price=11.0, cp="CP-B",
                                               sdate=D0 + dt.timedelta(days=5), status="Failed")],
                      exchange=[exchange_row("Z", qty=300)]))
    assert r["Z"].break_type == ("QUANTITY_MISMATCH | PRICE_MISMATCH | COUNTERPARTY_MISMATCH | "
                                 "DATE_MISMATCH | SETTLEMENT_FAILED | EXCHANGE_QTY_MISMATCH")
    assert r["Z"].break_value == 1000.0


def test_null_values_never_fire_a_check(spark):
    r = _by_id(_recon(spark,
                      internal=[internal_row("N", qty=None, price=None, cp=None, sdate=None,
                                             trade_date=None)],
                      custodian=[custodian_row("N", qty=5, price=1.0, cp="X", status=None)],
                      exchange=[exchange_row("N", qty=7)]))
    assert r["N"].break_type == "MATCHED" and r["N"].aging_bucket == "Unknown"


@pytest.mark.parametrize("days,bucket", [
    (-1, "T+0 to T+1"), (0, "T+0 to T+1"), (1, "T+0 to T+1"), (2, "T+2 to T+3"),
    (3, "T+2 to T+3"), (4, "4-7 days"), (7, "4-7 days"), (8, "8-30 days"), (30, "8-30 days"),
    (31, "31-90 days"), (90, "31-90 days"), (91, "90+ days"), (None, "Unknown")])
def test_aging_edges(spark, days, bucket):
    df = spark.createDataFrame([(days,)], "d int")
    assert df.selectExpr(f"{bucket_expr('d')} AS b").first().b == bucket


def test_aging_days_from_as_of(spark):
    as_of = CFG.as_of
    rows = [internal_row(f"T{d}", trade_date=as_of - dt.timedelta(days=d)) for d in (-1, 0, 4, 91)]
    r = _by_id(_recon(spark, internal=rows))
    assert {k: v.days_outstanding for k, v in r.items()} == {"T-1": -1, "T0": 0, "T4": 4, "T91": 91}


def test_null_keys_never_match_and_are_kept(spark):
    for strategy in ("keys", "chain"):
        df = _recon(spark, strategy=strategy,
                    internal=[internal_row(None, qty=1), internal_row(None, qty=2)],
                    custodian=[custodian_row(None, status="Failed")],
                    exchange=[exchange_row(None)])
        assert df.count() == 4, strategy
        assert df.where("quantity_int IS NOT NULL AND quantity_cust IS NOT NULL").count() == 0
        assert df.where("is_break").count() == 1


DUP_FEEDS = dict(internal=[internal_row("D", qty=1), internal_row("D", qty=2)],
                 custodian=[custodian_row("D", qty=1), custodian_row("D", qty=3),
                            custodian_row("D", qty=4)],
                 exchange=[exchange_row("D", qty=1), exchange_row("D", qty=2)])


def test_duplicate_keys_align_copies(spark):
    for strategy in ("keys", "chain"):
        rows = sorted((r.quantity_int or 0, r.quantity_cust or 0, r.quantity_exch or 0)
                      for r in _recon(spark, strategy=strategy, **DUP_FEEDS).collect())
        # twins meet, leftovers fill the free seats; every input row used once
        assert rows == [(0, 4, 0), (1, 1, 1), (2, 3, 2)], strategy


def test_align_spreads_a_hot_key(spark):
    """One key holding most rows: numbered over many slices, matched 1:1."""
    n = 3000
    internal = [internal_row("HOT", qty=q) for q in range(n)] + [internal_row("U1")]
    custodian = [custodian_row("HOT", qty=q) for q in range(n)] + [custodian_row("U1")]
    exchange = [exchange_row("HOT", qty=q) for q in range(0, n, 2)]
    df = _recon(spark, **dict(internal=internal, custodian=custodian, exchange=exchange))
    assert df.count() == n + 1
    assert df.where("quantity_int <> quantity_cust").count() == 0
    # exchange copies are the even quantities and meet their twins
    assert df.where("quantity_exch IS NOT NULL").count() == n // 2
    assert df.where("is_break").count() == 0


def test_twins_never_break(spark):
    """Copies that each have an exact twin in the other feeds are matched,
    whatever their order by date and whatever copy a feed lacks."""
    d1, d2 = dt.date(2025, 12, 1), dt.date(2025, 12, 2)
    df = _recon(spark, internal=[internal_row("D", qty=9, trade_date=d1), internal_row("D", qty=5, trade_date=d2)],
                custodian=[custodian_row("D", qty=5, trade_date=d2), custodian_row("D", qty=9, trade_date=d1)],
                exchange=[exchange_row("D", qty=5), exchange_row("D", qty=9)])
    assert df.where("is_break").count() == 0 and df.count() == 2
    df = _recon(spark, internal=[internal_row("D", qty=q) for q in (1, 2, 3)],
                custodian=[custodian_row("D", qty=q) for q in (1, 2, 3)],
                exchange=[exchange_row("D", qty=q) for q in (2, 3)])
    assert df.where("is_break").count() == 0 and df.count() == 3


def test_unreadable_values_cost_the_value_only(spark):
    """NaN, impossible dates and null tokens are missing values, and are counted."""
    from pyspark.sql import functions as F
    from settlekit.sources.feeds import feed_losses, validate
    nan = float("nan")
    raw = make_feeds(spark, internal=[internal_row("A", price=nan), internal_row("B"), internal_row("C"),
                                      internal_row(None)]).internal
    raw = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    raw = raw.withColumns({
        "trade_date": F.when(F.col("trade_id") == "B", "2025-13-45").otherwise(F.col("trade_date")),
        "counterparty": F.when(F.col("trade_id") == "C", "NA").otherwise(F.col("counterparty"))})
    lost = {r.column_name: (r.lost, r.missing) for r in feed_losses(raw, "internal", null_tokens=True).collect()}
    assert lost["price"] == (1, 1) and lost["trade_date"] == (1, 1) and lost["counterparty"] == (1, 1)
    assert lost["trade_id"] == (0, 1) and lost["quantity"] == (0, 0)
    feeds = make_feeds(spark, custodian=[custodian_row(k) for k in "ABC"], exchange=[exchange_row(k) for k in "ABC"])
    feeds = type(feeds)(validate(raw, "internal", null_tokens=True), feeds.custodian, feeds.exchange)
    ctx = ReconContext(spark, feeds, CFG)
    rows = {r.trade_id: r for r in ctx.recon.collect()}
    assert {rows[k].break_type for k in "ABC"} == {"MATCHED"}
    assert rows["B"].aging_bucket == "Unknown" and rows["C"].counterparty_int is None
    assert ctx.cube.count() > 0          # no value aborts the aggregation


def test_sums_are_exact_and_wide(spark):
    """Small amounts add up and large totals do not overflow."""
    small = [internal_row(f"S{n}", qty=1, price=0.004) for n in range(1000)]
    large = [internal_row(f"L{n}", qty=1_000_000, price=1e10) for n in range(20)]
    for rows, total in ((small, 4.0), (large, 2e17)):
        ctx = ReconContext(spark, make_feeds(
            spark, internal=rows, custodian=[custodian_row(r[0], qty=7, price=r[6]) for r in rows],
            exchange=[]), CFG)
        assert ctx.cube.where("dim = 'all'").first()["value"] == total


def test_fractional_quantity_tolerance(spark):
    feeds = dict(internal=[internal_row("A", qty=10)], custodian=[custodian_row("A", qty=11)], exchange=[])
    assert _recon(spark, CFG.with_(qty_tol=0.5), **feeds).first().is_break
    assert not _recon(spark, CFG.with_(qty_tol=1.5), **feeds).first().is_break


def test_strategies_agree_on_mixed_fixture(spark):
    feeds = dict(
        internal=[internal_row("A"), internal_row("B", qty=5), internal_row(None),
                  internal_row("D"), internal_row("D", qty=9)],
        custodian=[custodian_row("A", status="Failed"), custodian_row("C", status="Failed"),
                   custodian_row("D", price=10.5), custodian_row(None, status="Failed")],
        exchange=[exchange_row("B", qty=6), exchange_row("E"), exchange_row("D")])
    cols = list(schemas.REPORT_COLUMNS)
    a = Counter(tuple(r) for r in _recon(spark, strategy="keys", **feeds).select(cols).collect())
    b = Counter(tuple(r) for r in _recon(spark, strategy="chain", **feeds).select(cols).collect())
    # A, B, C, D (2 internal copies), E, and the two null-key rows
    assert a == b and sum(a.values()) == 1 + 1 + 1 + 2 + 1 + 2


def test_empty_feeds(spark):
    ctx = _ctx(spark)
    k = summaries.kpis(ctx.cube).first()
    assert (k.total_trades, k.total_breaks, k.match_rate) == (0, 0, None)
    assert trend.daily_trend_change(ctx.daily).count() == 0
    assert alerts.anomaly_alerts(ctx.cube, CFG).count() == 0


def test_single_day_has_no_spike(spark):
    daily = _ctx(spark, internal=[internal_row("A")], custodian=[custodian_row("A", qty=1)]).daily
    s = trend.break_rate_stats(daily, CFG).first()
    assert s.days == 1 and s.std_rate is None
    assert trend.break_rate_spikes(daily, CFG).count() == 0
    ch = trend.daily_trend_change(daily).first()
    assert ch.latest_date == ch.previous_date and ch.trend == "remained stable"


@pytest.mark.parametrize("n,fires", [(100, False), (101, True)])
def test_failed_settlement_threshold_is_strict(spark, n, fires):
    cube = _ctx(spark, custodian=[custodian_row(f"F{i}", status="Failed") for i in range(n)]).cube
    assert alerts.failed_settlements(cube, CFG).first().alert_fires is fires


def test_high_value_threshold_is_strict(spark):
    cube = _ctx(spark,
                internal=[internal_row("H1", qty=100000, price=10.0),
                          internal_row("H2", qty=100001, price=10.0)],
                custodian=[custodian_row("H1", qty=1), custodian_row("H2", qty=1)]).cube
    f = alerts.high_value_breaks(cube, CFG).first()
    assert f.high_value_count == 1 and f.high_value_total == 1000010.0


def test_concentration_share_exactly_at_limit(spark):
    # 10 counterparties with one break each: every share is exactly 10 %
    rows_i = [internal_row(f"K{i}", cp=f"CP{i}") for i in range(10)]
    rows_c = [custodian_row(f"K{i}", cp=f"CP{i}", status="Failed") for i in range(10)]
    cube = _ctx(spark, internal=rows_i, custodian=rows_c).cube
    assert alerts.counterparty_concentration(cube, CFG).count() == 0
    # one more break for CP0 -> 2/11 = 18.2 % > 10 %
    rows_i.append(internal_row("K10", cp="CP0"))
    rows_c.append(custodian_row("K10", cp="CP0", status="Failed"))
    cube = _ctx(spark, internal=rows_i, custodian=rows_c).cube
    assert [r.counterparty for r in alerts.counterparty_concentration(cube, CFG).collect()] == ["CP0"]


def test_alert_order_and_kb_document(spark):
    import json
    from settlekit.operators import insights
    old = CFG.as_of - dt.timedelta(days=91)
    rows_i = [internal_row(f"K{i}", cp=f"CP{i % 3}", qty=200000, trade_date=old) for i in range(150)]
    rows_c = [custodian_row(f"K{i}", cp=f"CP{i % 3}", qty=200000, trade_date=old, status="Failed")
              for i in range(150)]
    ctx = ReconContext(spark, make_feeds(spark, internal=rows_i, custodian=rows_c),
                       CFG.with_(report_date=dt.date(2026, 1, 2)))
    al = alerts.anomaly_alerts(ctx.cube, ctx.cfg).orderBy("alert_rank").collect()
    assert [a.alert_type for a in al] == ["COUNTERPARTY_CONCENTRATION"] * 3 + [
        "HIGH_VALUE_BREAKS", "AGING_BREAKS", "FAILED_SETTLEMENT_VOLUME"]
    assert [a.alert_rank for a in al] == list(range(1, 7))
    doc = json.loads(insights.kb_document(ctx.cube, ctx.cfg).first().kb_json)
    assert doc["overview"] == {"total_trades": 150, "total_breaks": 150, "match_rate": 0.0,
                               "total_break_value": 150 * 200000 * 10.0,
                               "report_date": "2026-01-02"}
    assert doc["counterparty_breaks"]["CP0"]["break_value"] == 50 * 200000 * 10
    assert list(doc["break_types"]) == ["settlement_failed"]
    assert list(doc["counterparty_breaks"]) == ["CP0", "CP1", "CP2"]
    assert len(doc["faq_pairs"]) == 6
    assert doc["faq_pairs"][5]["answer"].startswith("alerts=6; first=[MEDIUM] COUNTERPARTY")


@pytest.mark.parametrize("x,d", [(0.285, 2), (17.225, 2), (2.5, 0), (3.5, 0), (-2.5, 0),
                                 (82.85, 1), (20.125, 2), (1234.5, 0)])
def test_rounding_matches_numpy(spark, x, d):
    got = spark.range(1).select(half_even(F.lit(x), d).alias("r")).first().r
    assert got == float(np.round(x, d))


@pytest.mark.parametrize("x,d", [(0.5, 0), (2.5, 0), (1234567.25, 1), (0.125, 2), (2.675, 2),
                                 (754869433.0, 0), (5.14018691588785, 1), (-1.05, 1)])
def test_format_number_matches_python(spark, x, d):
    got = spark.range(1).select(F.format_number(F.lit(x), d).alias("s")).first().s
    assert got == f"{x:,.{d}f}"


def test_internal_vs_custodian_aligns_and_keeps_null_keys(spark):
    from settlekit.operators import reconcile
    feeds = make_feeds(spark,
                       internal=[internal_row("D", qty=1), internal_row("D", qty=2),
                                 internal_row(None), internal_row("A")],
                       custodian=[custodian_row("D", qty=2), custodian_row(None),
                                  custodian_row("B")])
    rows = sorted((r.trade_id or "-", r.quantity_int or 0, r.quantity_cust or 0)
                  for r in reconcile.internal_vs_custodian(feeds).collect())
    assert rows == [("-", 0, 100), ("-", 100, 0), ("A", 100, 0), ("B", 0, 100),
                    ("D", 1, 0), ("D", 2, 2)]


def test_identical_hot_copies_are_numbered_once_each(spark):
    """A key whose copies are all identical still gets seq 1..n exactly once
    (range keys are made distinct by the scan position)."""
    from settlekit.operators import reconcile
    n = 2000
    df = spark.createDataFrame([internal_row("HOT")] * n + [internal_row("U")],
                               schemas.INTERNAL).repartition(4)
    out = reconcile.number(df, ["trade_id"], ["quantity", "price"], "seq")
    seqs = sorted(r.seq for r in out.where("trade_id = 'HOT'").select("seq").collect())
    assert seqs == list(range(1, n + 1))
    assert out.where("trade_id = 'U'").first().seq == 1
