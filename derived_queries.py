"""The registered reconciliation queries: the report queries of
``settlekit.plans.catalog`` over feeds derived from the driver's tables
(derived_feeds.py), and queries over feeds of other make.

Every query reads the driver's tables (so its work grows with them) and
covers the whole reconciled table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derived_feeds import derive_feeds, duplicate_feeds
from settlekit import schemas
from settlekit.config import ReconConfig
from settlekit.plans.catalog import QUERIES
from settlekit.plans.context import ReconContext
from settlekit.plans.daily import DayStore
from settlekit.session import scratch
from settlekit.sources.bucketed import write_bucketed
from settlekit.sources.feeds import Feeds, read_feeds, validate

# Parameters for the feeds derived from orders/customer/nation: as_of is the
# last order date; amounts there stop near 500,000 and 25 counterparties
# share the breaks at 4-5 % each, so the two alert thresholds are lowered to
# make those rules fire.  Library defaults are unchanged.
DERIVED_FEED_CONFIG = ReconConfig(
    as_of=_dt.date(2001, 8, 1),
    report_date=_dt.date(2001, 8, 1),
    high_value=400_000.0,
    concentration_pct=4.5,
)


_FEEDS: dict[tuple, Feeds] = {}
_SHARED: dict[tuple, ReconContext] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the input tables, so that changed input is noticed."""
    out = []
    for t in ("orders", "customer", "nation"):
        p = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        s = p.getFileSystem(spark._jsc.hadoopConfiguration())
        out += [s.getContentSummary(p).getLength(), s.getFileStatus(p).getModificationTime()]
    return spark.sparkContext.applicationId, sf_dir, *out


def shared_feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    """The feeds derived from sf_dir; their base is written once per application."""
    key = _stamp(spark, sf_dir)
    if key not in _FEEDS:
        _FEEDS[key] = derive_feeds(spark, sf_dir)
    return _FEEDS[key]


def context_for(spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None) -> ReconContext:
    """A fresh context over the feeds derived from sf_dir."""
    return ReconContext(spark, shared_feeds(spark, sf_dir), cfg or DERIVED_FEED_CONFIG)


def shared_context(spark: SparkSession, sf_dir: str, cfg: ReconConfig | None = None) -> ReconContext:
    """One context per (application, input, config).  The reconciled rows are
    written by the first query that returns rows (``run``); summaries need the
    written aggregates only, whose join reads the columns they count."""
    cfg = cfg or DERIVED_FEED_CONFIG
    key = (*_stamp(spark, sf_dir), cfg)
    ctx = _SHARED.get(key)
    if ctx is None:
        ctx = _SHARED[key] = context_for(spark, sf_dir, cfg)
    return ctx


def release_shared() -> None:
    """Delete what the shared contexts have written and forget them."""
    for ctx in _SHARED.values():
        ctx.release()
    _SHARED.clear()


def _dirty_internal(feeds: Feeds) -> DataFrame:
    """The internal feed as text with unreadable values in it: every 7th
    price NaN, every 11th trade date impossible, every 13th counterparty NA."""
    feed = feeds.internal
    key = F.substring("trade_id", 5, 20).cast("bigint")
    raw = feed.select([F.col(c).cast("string").alias(c) for c in feed.columns])
    return raw.withColumns({
        "price": F.when(key % 7 == 0, "NaN").otherwise(F.col("price")),
        "trade_date": F.when(key % 11 == 0, "2025-13-45").otherwise(F.col("trade_date")),
        "counterparty": F.when(key % 13 == 0, "NA").otherwise(F.col("counterparty"))})


def dirty_feed_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Losses of the internal feed, counted on the joined rows."""
    return audited_context(spark, sf_dir).feed_losses.where("feed = 'internal'")


def dirty_feed_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = shared_feeds(spark, sf_dir)
    feeds = Feeds(validate(_dirty_internal(feeds), "internal", null_tokens=True), feeds.custodian, feeds.exchange)
    return ReconContext(spark, feeds, DERIVED_FEED_CONFIG).recon.select(
        "trade_id", "counterparty_int", "price_int", "aging_bucket", "break_type")


def duplicate_key_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairing of duplicated keys on the lines of orders."""
    ctx = ReconContext(spark, duplicate_feeds(spark, sf_dir), DERIVED_FEED_CONFIG)
    return ctx.recon.select("trade_id", "quantity_int", "price_int", "quantity_cust", "price_cust",
                            "quantity_exch", "price_exch", "break_type")


def text_feed_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds as CSV files of two layouts, one in reverse order and with
    a further column, read by their headers and reconciled."""
    paths = {}
    for name, feed in shared_feeds(spark, sf_dir).as_dict().items():
        paths[name] = scratch(spark, f"text-{name}")
        even = F.substring("trade_id", 5, 20).cast("bigint") % 2 == 0
        feed.filter(even).write.option("header", "true").csv(f"{paths[name]}/even")
        feed.filter(~even).select(F.lit("x").alias("own"), *reversed(feed.columns)).write.option(
            "header", "true").csv(f"{paths[name]}/odd")
    feeds = read_feeds(spark, *[f"{paths[n]}/*" for n in ("internal", "custodian", "exchange")], fmt="csv")
    return ReconContext(spark, feeds, DERIVED_FEED_CONFIG).joined.select(*schemas.JOINED_COLUMNS)


_PUBLISHED: dict[tuple, str] = {}


def reopened(spark: SparkSession, sf_dir: str) -> ReconContext:
    """A published run of the derived feeds, opened without them."""
    key = _stamp(spark, sf_dir)
    if key not in _PUBLISHED:
        _PUBLISHED[key] = scratch(spark, "published")
        shared_context(spark, sf_dir).publish(_PUBLISHED[key])
    return ReconContext.open(spark, _PUBLISHED[key], DERIVED_FEED_CONFIG)


def audited_context(spark: SparkSession, sf_dir: str) -> ReconContext:
    """The derived feeds, the internal one with unreadable values, audited."""
    feeds = shared_feeds(spark, sf_dir)
    internal = validate(_dirty_internal(feeds), "internal", null_tokens=True, audit=True)
    others = {n: validate(df, n, audit=True) for n, df in feeds.as_dict().items() if n != "internal"}
    return ReconContext(spark, Feeds(internal, **others), DERIVED_FEED_CONFIG)


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited_context(spark, sf_dir).rejected_rows.select(
        "feed", "trade_id", F.array_join("lost_columns", ",").alias("lost_columns"),
        F.get_json_object("raw", "$.price").alias("raw_price"))


def bucketed_recon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds written in buckets and joined without a shuffle."""
    feeds = write_bucketed(shared_feeds(spark, sf_dir), scratch(spark, "bucketed"), 16)
    return ReconContext(spark, feeds, DERIVED_FEED_CONFIG).joined.select(*schemas.JOINED_COLUMNS)


def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days kept from feeds in which one trade date came wrong, that date
    replaced by its right feeds: the daily trend."""
    feeds, wrong = shared_feeds(spark, sf_dir), _dt.date(1998, 3, 3)
    at = F.col("trade_date") == F.lit(wrong)
    damaged = Feeds(feeds.internal.withColumn("quantity", F.when(at, F.lit(1).cast("long")).otherwise(F.col("quantity"))),
                    feeds.custodian.where(~at), feeds.exchange)
    store = DayStore.create(spark, damaged, scratch(spark, "days"), DERIVED_FEED_CONFIG)
    return store.replace([wrong], feeds).context().daily


#: report queries that return reconciled rows
ROW_QUERIES = ("three_way_recon", "break_flags", "break_aging", "reconciliation_report", "settlement_breaks")

#: queries on feeds of other make than the shared ones
OTHER_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_losses": dirty_feed_losses,
    "dirty_feed_labels": dirty_feed_labels,
    "duplicate_key_recon": duplicate_key_recon,
    "text_feed_recon": text_feed_recon,
    "rejected_rows": rejected_rows,
    "bucketed_recon": bucketed_recon,
    "replaced_days": replaced_days,
    "reopened_alerts": lambda spark, sf_dir: QUERIES["anomaly_alerts"](reopened(spark, sf_dir)),
    "reopened_kb": lambda spark, sf_dir: QUERIES["kb_document"](reopened(spark, sf_dir)),
}


def run(name: str, spark: SparkSession, sf_dir: str, shared: bool = True) -> DataFrame:
    if name in OTHER_QUERIES:
        return OTHER_QUERIES[name](spark, sf_dir)
    ctx = shared_context(spark, sf_dir) if shared else context_for(spark, sf_dir)
    if shared and name in ROW_QUERIES:
        ctx.materialize()
    return QUERIES[name](ctx)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run("counterparty_summary", spark, sf_dir).orderBy(F.desc("breaks"),
                                                              F.asc("counterparty_int"))
