"""Plan shape (no Python in any plan, one shuffle per feed, pruned scans),
sinks read back, and the streaming classification."""

import json

import pytest

import __spark_entry__ as entry
from conftest import SF001
from fixtures import custodian_row, exchange_row, internal_row, make_feeds
from settlekit import schemas
from settlekit.config import ReconConfig
from settlekit.operators.cube import row_aggregates
import derived_queries as catalog
from settlekit.plans.context import ReconContext
from settlekit.sources import sinks
from settlekit import streaming


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted([*catalog.QUERIES, *catalog.OTHER_QUERIES]))
def test_no_python_in_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, SF001))
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas",
                   "MapInPandas"):
        assert marker not in plan, (name, marker)


@pytest.fixture
def no_auto_broadcast(spark):
    """The at-scale plan: tiny test feeds would otherwise pass Catalyst's
    broadcast size check."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def _nodes(df) -> list[str]:
    """Physical operator names of a plan (descending into AQE's current plan,
    not into cached relations)."""
    out = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        out.append(name + (" " + node.joinType().toString() if name == "SortMergeJoin" else ""))
        kids = node.children()
        for k in range(kids.size()):
            walk(kids.apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_keys_strategy_shuffles_each_feed_once(spark, no_auto_broadcast):
    ctx = catalog.context_for(spark, SF001)
    nodes = _nodes(ctx.joined)
    # the key table (one aggregation, already cached by the duplicate check)
    # feeds the joins without a shuffle; each feed is shuffled once
    assert nodes.count("Exchange") == 3
    assert nodes.count("InMemoryTableScan") == 1
    assert [n for n in nodes if n.startswith("SortMergeJoin")] == ["SortMergeJoin LeftOuter"] * 3
    chain = catalog.context_for(spark, SF001, catalog.DERIVED_FEED_CONFIG.with_(strategy="chain"))
    assert [n for n in _nodes(chain.joined) if n.startswith("SortMergeJoin")] == \
        ["SortMergeJoin FullOuter"] * 2


def test_cube_scan_is_pruned(spark, tmp_path):
    ctx = catalog.context_for(spark, SF001).materialize()
    plan = _plan(row_aggregates(ctx.recon, ctx.cfg))
    schema = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schema and "booking_time" not in schema[0] and "exchange_ref" not in schema[0]
    assert plan.count("Expand") == 1


def test_cube_is_one_pass(spark, no_auto_broadcast):
    """Cold: three joins, one Expand, and no single-task aggregation of the rows."""
    ctx = catalog.context_for(spark, SF001)
    df = row_aggregates(ctx.recon, ctx.cfg)
    df.collect()
    nodes = _nodes(df)
    assert nodes.count("Expand") == 1
    assert len([n for n in nodes if n.startswith("SortMergeJoin")]) == 3
    assert "SinglePartition" not in _plan(df) and "Coalesce" not in nodes


def test_write_all_reads_back(spark, tmp_path):
    ctx = catalog.context_for(spark, SF001)
    paths = sinks.write_all(ctx, str(tmp_path / "out"))
    report = spark.read.parquet(paths["reconciliation_report"])
    assert report.columns == list(schemas.REPORT_COLUMNS)
    assert report.count() == ctx.report.count()
    assert spark.read.parquet(paths["settlement_breaks"]).count() == ctx.settlement_breaks.count()
    cs = spark.read.option("header", "true").csv(paths["counterparty_summary"])
    assert cs.count() == ctx.counterparty_summary.count()
    assert [r.breaks for r in cs.collect()] == sorted((r.breaks for r in cs.collect()), key=int, reverse=True)
    assert not any("E" in r.total_break_value for r in cs.collect())
    days = [r.trade_date_str for r in spark.read.option("header", "true").csv(paths["daily_break_trend"]).collect()]
    assert days == sorted(days)
    alerts = spark.read.json(paths["anomaly_alerts"])
    assert dict(alerts.dtypes)["dates"] == "array<string>" and {"type", "count"} <= set(alerts.columns)
    assert alerts.count() == catalog.QUERIES["anomaly_alerts"](ctx).count()
    doc = json.loads(spark.read.text(paths["knowledge_base"]).first().value)
    assert doc["overview"]["total_trades"] == report.count()


def test_stream_classification_matches_batch(spark, tmp_path):
    feeds = make_feeds(
        spark,
        internal=[internal_row("A"), internal_row("B", qty=5), internal_row("C")],
        custodian=[custodian_row("A", status="Failed"), custodian_row("B"), custodian_row("C")],
        exchange=[exchange_row("C", qty=9)])
    cfg = ReconConfig()
    batch = ReconContext(spark, feeds, cfg)
    src = tmp_path / "joined"
    batch.joined.write.parquet(str(src))
    stream = spark.readStream.schema(streaming.joined_schema(spark)).parquet(str(src))
    q = streaming.stream_breaks_to_parquet(stream, str(tmp_path / "breaks"),
                                           str(tmp_path / "ckpt"), cfg, trigger_once=True)
    q.awaitTermination(120)
    got = {r.trade_id: r.break_type for r in spark.read.parquet(str(tmp_path / "breaks")).collect()}
    want = {r.trade_id: r.break_type for r in batch.settlement_breaks.collect()}
    assert got == want == {"A": "SETTLEMENT_FAILED", "B": "QUANTITY_MISMATCH",
                           "C": "EXCHANGE_QTY_MISMATCH"}


def test_csv_feeds_read_with_declared_schemas(spark, tmp_path):
    """Feeds as CSV with a header are read with the declared schemas
    (no inference) and reconcile to the same rows as the parquet feeds."""
    from settlekit.sources.feeds import read_feeds
    landed = catalog.shared_feeds(spark, SF001)
    for name, df in landed.as_dict().items():
        df.write.option("header", "true").csv(str(tmp_path / name))
    csv = read_feeds(spark, str(tmp_path / "internal"), str(tmp_path / "custodian"),
                     str(tmp_path / "exchange"), fmt="csv", header="true")
    for name, df in csv.as_dict().items():
        assert df.dtypes == landed.as_dict()[name].dtypes, name
    a = ReconContext(spark, csv, catalog.DERIVED_FEED_CONFIG)
    b = ReconContext(spark, landed, catalog.DERIVED_FEED_CONFIG)
    cols = list(schemas.REPORT_COLUMNS)
    assert a.report.select(cols).exceptAll(b.report.select(cols)).count() == 0
    assert a.report.count() == b.report.count() == 1500


def test_missing_feed_column_fails_early(spark):
    from settlekit.sources.feeds import FeedSchemaError, validate
    bad = spark.createDataFrame([("T1", 1)], "trade_id string, quantity long")
    with pytest.raises(FeedSchemaError):
        validate(bad, "internal")


def test_trade_dates_do_not_depend_on_session_time_zone(spark):
    from derived_feeds import derive_feeds
    confs = {"spark.sql.session.timeZone": "America/Los_Angeles",
             "spark.sql.parquet.inferTimestampNTZ.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        r = derive_feeds(spark, SF001).internal.selectExpr(
            "CAST(min(trade_date) AS STRING) AS lo", "CAST(max(trade_date) AS STRING) AS hi").first()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert (r.lo, r.hi) == ("1995-01-01", "2001-08-01")
