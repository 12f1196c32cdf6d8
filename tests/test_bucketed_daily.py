"""Joins of bucketed feeds without a shuffle; days that replace their slice."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import derived_queries as catalog
from conftest import SF001, SF01
from fixtures import custodian_row, exchange_row, internal_row, make_feeds
from settlekit import schemas
from settlekit.plans import runs
from settlekit.plans.context import ReconContext
from settlekit.plans.daily import DayStore, feeds_of
from settlekit.sources.bucketed import BucketedFeeds, open_bucketed, write_bucketed
from settlekit.sources.feeds import Feeds

CFG = catalog.DERIVED_FEED_CONFIG
DAY = dt.date(1998, 3, 3)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _same(a, b):
    return a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).count() == 0


def _report(spark, feeds):
    return ReconContext(spark, feeds, CFG).report


def test_bucketed_join_has_no_exchange(spark, tmp_path, no_broadcast):
    feeds = catalog.shared_feeds(spark, SF001)
    bucketed = write_bucketed(feeds, str(tmp_path / "b"), 4)
    ctx = ReconContext(spark, bucketed, CFG)
    ctx.joined.collect()
    plan = ctx.joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert [x for x in plan.splitlines() if "Exchange" in x] == []
    assert plan.count("SortMergeJoin") == 6 and "Bucketed: true" in plan
    assert _same(ctx.report, _report(spark, feeds))
    other = open_bucketed(spark.newSession(), str(tmp_path / "b"))
    assert isinstance(other, BucketedFeeds) and other.buckets == 4
    assert ReconContext(other.internal.sparkSession, other, CFG).report.count() == 1500


def test_bucketed_feeds_with_null_and_double_keys(spark, tmp_path):
    rows = dict(
        internal=[internal_row("A"), internal_row("B"), internal_row(None), internal_row("E")],
        custodian=[custodian_row("A", qty=1), custodian_row("C"), custodian_row(None)],
        exchange=[exchange_row("A"), exchange_row("C"), exchange_row("D"), exchange_row("E", qty=7), exchange_row(None)])
    feeds = make_feeds(spark, **rows)
    bucketed = write_bucketed(feeds, str(tmp_path / "a"), 3)
    assert bucketed.unique and _same(_report(spark, bucketed), _report(spark, feeds))
    rows["custodian"] += [custodian_row("A", qty=1), custodian_row("A", qty=2)]
    feeds = make_feeds(spark, **rows)
    bucketed = write_bucketed(feeds, str(tmp_path / "b"), 3)
    assert not bucketed.unique and _same(_report(spark, bucketed), _report(spark, feeds))
    empty = make_feeds(spark)
    bucketed = write_bucketed(empty, str(tmp_path / "c"), 3)
    assert _report(spark, bucketed).count() == 0


@pytest.fixture
def stored(spark, tmp_path):
    """Three weeks of the derived feeds in folders by trade date, damaged on one
    day, and their store."""
    weeks = F.col("trade_date").between(DAY - dt.timedelta(days=10), DAY + dt.timedelta(days=10))
    feeds = Feeds(*[df.where(weeks) for df in catalog.shared_feeds(spark, SF01).as_dict().values()])
    day = F.col("trade_date") == F.lit(DAY)
    damaged = Feeds(feeds.internal.withColumn("price", F.when(day, F.col("price") + 5).otherwise(F.col("price"))),
                    feeds.custodian.where(~day), feeds.exchange)
    store = DayStore.create(spark, damaged, str(tmp_path / "days"), CFG)
    paths = {}
    for name, df in feeds.as_dict().items():
        paths[name] = str(tmp_path / name)
        df.withColumn("part", F.col("trade_date")).repartition("part").write.partitionBy("trade_date").parquet(paths[name])
    right = Feeds(*[spark.read.parquet(paths[n]).select(df.columns) for n, df in feeds.as_dict().items()])
    return store, right, paths, damaged, feeds


def _tables(ctx):
    names = ["recon_kpis", "counterparty_summary", "trade_type_summary", "daily_break_trend", "aging_summary",
             "breaks_by_weekday", "status_distribution", "modal_break_pattern", "anomaly_alerts", "kb_document", "feed_counts"]
    return {n: sorted(map(str, catalog.QUERIES[n](ctx).collect())) for n in names}


def test_replacing_a_day_equals_a_full_run_and_reads_that_day_only(spark, stored):
    store, right, paths, damaged, feeds = stored
    assert _tables(store.context()) == _tables(ReconContext(spark, damaged, CFG))
    for path in paths.values():                       # no other day can be read any more
        for folder in os.listdir(path):
            if folder.startswith("trade_date=") and folder != f"trade_date={DAY}":
                for f in os.listdir(f"{path}/{folder}"):
                    os.truncate(f"{path}/{folder}/{f}", 3)
    new = store.replace([DAY], right)
    assert _tables(new.context()) == _tables(ReconContext(spark, feeds, CFG))
    assert _tables(store.context()) == _tables(ReconContext(spark, damaged, CFG))      # the old store still stands
    plan = feeds_of(right, [DAY]).internal._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*trade_date", plan)
    again = new.compact()
    assert _tables(again.context()) == _tables(ReconContext(spark, feeds, CFG))
    assert _tables(DayStore(spark, store.path).context()) == _tables(again.context())


def test_days_that_come_go_and_have_no_date(spark, tmp_path):
    def feeds(days):
        rows = [(f"{d}-{k}", d) for d in days for k in range(3)]
        return make_feeds(spark, [internal_row(t, qty=5, trade_date=d) for t, d in rows],
                          [custodian_row(t, qty=4 + int(t[-1]), trade_date=d) for t, d in rows])
    one, two, three = (dt.date(2025, 12, d) for d in (1, 2, 3))
    store = DayStore.create(spark, feeds([one, two, None]), str(tmp_path / "s"), CFG)
    assert store.manifest["base"] and store.days.select("slice_day").distinct().count() == 3
    store = store.replace([two, three, None], feeds([one, three]))
    assert _tables(store.context()) == _tables(ReconContext(spark, feeds([one, three]), CFG))
    store = store.replace([one, three], feeds([])).replace([None], feeds([None]))
    assert _tables(store.context()) == _tables(ReconContext(spark, feeds([None]), CFG))


def test_feeds_that_disagree_on_a_date_are_refused(spark, tmp_path):
    feeds = make_feeds(spark, [internal_row("A")], [custodian_row("A", trade_date=dt.date(2025, 12, 2))])
    with pytest.raises(ValueError, match="disagree"):
        DayStore.create(spark, feeds, str(tmp_path / "s"), CFG)
    with pytest.raises(runs.RunError):
        DayStore(spark, str(tmp_path / "s"))


def test_presence_columns_are_no_part_of_the_report(spark):
    ctx = catalog.shared_context(spark, SF001)
    assert tuple(ctx.report.columns) == schemas.REPORT_COLUMNS
    assert set(schemas.PRESENCE_COLUMNS) <= set(ctx.recon.columns)
