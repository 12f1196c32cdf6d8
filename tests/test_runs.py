"""Published runs: all or nothing, reopened without feeds, refused when stale
or not whole; feed counts, losses and rejected rows without a feed scan."""

import json
import os

import pytest

import __spark_entry__ as entry
import derived_queries as catalog
from conftest import SF001
from settlekit import schemas
from settlekit.operators import alerts, insights
from settlekit.plans import runs
from settlekit.plans.context import ReconContext
from settlekit.sources import sinks
from settlekit.sources.feeds import FeedSchemaError, feed_losses, read_feeds


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """The derived feeds as parquet files."""
    d = tmp_path_factory.mktemp("feeds")
    for name, df in catalog.shared_feeds(spark, SF001).as_dict().items():
        df.write.parquet(f"{d}/{name}")
    return {name: f"{d}/{name}" for name in schemas.LEGS}


def _context(spark, inputs):
    return ReconContext(spark, read_feeds(spark, **inputs), catalog.DERIVED_FEED_CONFIG)


def _same(a, b):
    return a.columns == b.columns and a.count() == b.count() and a.exceptAll(b).count() == 0


def test_a_fresh_session_starts_from_the_tables(spark, inputs, tmp_path):
    ctx = _context(spark, inputs)
    run = ctx.publish(str(tmp_path / "out"), inputs=inputs)
    assert run.number == 1 and set(os.listdir(tmp_path / "out")) == {"_runs", f"run-{run.manifest['run']}"}
    other = spark.newSession()
    again = ReconContext.open(other, str(tmp_path / "out"), catalog.DERIVED_FEED_CONFIG, inputs)
    with pytest.raises(runs.RunError):
        again.feeds
    for name, query in catalog.QUERIES.items():
        if name != "internal_vs_custodian":          # a join of the feeds
            assert _same(query(again), query(ctx)), name
    assert json.loads(insights.kb_document(again.cube, again.cfg).first().kb_json)["overview"]["total_trades"] == 1500
    assert alerts.anomaly_alerts(again.cube, again.cfg).count() > 0


@pytest.mark.parametrize("fmt", ["csv", "orc", "json"])
def test_other_formats_reopen(spark, inputs, tmp_path, fmt):
    ctx = _context(spark, inputs)
    ctx.publish(str(tmp_path), fmt)
    assert _same(ReconContext.open(spark, str(tmp_path)).report, ctx.report)


def test_a_failing_write_leaves_the_old_run(spark, inputs, tmp_path, monkeypatch):
    out = str(tmp_path)
    ctx = _context(spark, inputs)
    first = ctx.publish(out)
    monkeypatch.setattr(sinks, "write_text", lambda *a, **k: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        ctx.publish(out)
    assert runs.current(spark, out) == first and len(os.listdir(tmp_path)) == 2
    assert _same(ReconContext.open(spark, out).report, ctx.report)


def test_a_manifest_being_written_is_no_run(spark, inputs, tmp_path):
    out = str(tmp_path)
    ctx = _context(spark, inputs)
    with pytest.raises(runs.RunError):
        ReconContext.open(spark, out)
    first = ctx.publish(out)
    (tmp_path / "_runs" / "00000002.json").write_text('{"format": 1, "run": "x", "tab')
    assert runs.current(spark, out) == first
    third = ctx.publish(out)
    assert third.number == 3 and runs.current(spark, out) == third


def test_old_runs_stay_for_their_readers(spark, inputs, tmp_path):
    out = str(tmp_path)
    ctx = _context(spark, inputs)
    made = [ctx.publish(out, keep=2) for _ in range(4)]
    assert [r.number for r in made] == [1, 2, 3, 4]
    assert sorted(os.listdir(tmp_path / "_runs"))[-2:] == ["00000003.json", "00000004.json"]
    assert _same(ReconContext.open(spark, out, number=3).report, ctx.report)
    assert len([d for d in os.listdir(tmp_path) if d.startswith("run-")]) == 2


def test_partial_and_stale_runs_are_refused(spark, inputs, tmp_path):
    out = str(tmp_path / "out")
    feeds = dict(inputs)
    for name, path in inputs.items():
        spark.read.parquet(path).write.parquet(str(tmp_path / name))
        feeds[name] = str(tmp_path / name)
    run = _context(spark, feeds).publish(out, inputs=feeds)
    runs.check(spark, run, catalog.DERIVED_FEED_CONFIG, feeds)
    with pytest.raises(runs.StaleRunError, match="high_value"):
        ReconContext.open(spark, out, catalog.DERIVED_FEED_CONFIG.with_(high_value=1.0))
    spark.read.parquet(feeds["exchange"]).limit(1).write.mode("append").parquet(feeds["exchange"])
    with pytest.raises(runs.StaleRunError, match="exchange"):
        ReconContext.open(spark, out, inputs=feeds)
    report = tmp_path / "out" / run.manifest["tables"]["reconciliation_report"]["path"]
    part = next(f for f in os.listdir(report) if f.startswith("part-"))
    os.truncate(report / part, 100)
    with pytest.raises(runs.RunError, match="not whole"):
        ReconContext.open(spark, out)


def test_counts_read_no_feed(spark, inputs):
    ctx = _context(spark, inputs).materialize()
    ctx.cube
    counts = catalog.QUERIES["feed_counts"](ctx)
    assert {r.feed: r.rows for r in counts.collect()} == {
        **{n: df.count() for n, df in ctx.feeds.as_dict().items()}, "reconciled": 1500}
    assert not any(path in counts._jdf.queryExecution().toString() for path in inputs.values())


def test_losses_and_rejects_come_with_the_joined_rows(spark, tmp_path):
    names = [f.name for f in schemas.INTERNAL.fields]
    good = ["T1", "2025-01-02", "2025-01-04", "TK", "Buy", "5", "10.5", "CP", "USD", "52.5", "internal", "T", "D", "9:00"]
    rows = [good, ["T2", "2025-13-45", *good[2:5], "many", *good[6:]], ["", *good[1:]], ["T4", *good[1:6], "NaN", *good[7:]],
            ["T5", *good[1:7], "NA", *good[8:]], ["T6", "2025-01-02"], [*good, "too", "many"]]
    (tmp_path / "internal.csv").write_text("\n".join(",".join(r) for r in [names, *rows]) + "\n")
    for n in ("custodian", "exchange"):
        (tmp_path / f"{n}.csv").write_text(",".join(f.name for f in schemas.FEED_SCHEMAS[n].fields) + "\n")
    feeds = read_feeds(spark, *[str(tmp_path / f"{n}.csv") for n in schemas.LEGS], fmt="csv", audit=True)
    ctx = ReconContext(spark, feeds).materialize()
    got = {r.trade_id: (r.lost_columns, r.raw) for r in ctx.rejected_rows.collect() if r.trade_id != "T1"}
    assert set(got) == {"T2", None, "T4", "T5", "T6"}
    assert got["T2"][0] == ["trade_date", "quantity"] and json.loads(got["T2"][1])["quantity"] == "many"
    assert got["T4"][0] == ["price"] and got["T5"][0] == ["counterparty"] and got["T6"] == ([], "T6,2025-01-02")
    assert [r.raw for r in ctx.rejected_rows.filter("trade_id = 'T1'").collect()] == [",".join([*good, "too", "many"])]
    losses = ctx.feed_losses
    assert "internal.csv" not in losses._jdf.queryExecution().toString()
    raw = spark.read.option("header", "true").csv(str(tmp_path / "internal.csv"))
    want = {tuple(r) for r in feed_losses(raw, "internal", null_tokens=True).collect()}
    got = {tuple(r) for r in losses.filter("feed = 'internal'").collect()}
    # the plain reader already takes an empty key as NULL, so it does not count it as lost
    assert {x for x in got if x[1] != "trade_id"} == {x for x in want if x[1] != "trade_id"}
    plain = ReconContext(spark, read_feeds(spark, *[str(tmp_path / f"{n}.csv") for n in schemas.LEGS], fmt="csv"))
    assert _same(plain.report, ctx.report)
    with pytest.raises(FeedSchemaError):
        plain.feed_losses
    paths = sinks.write_all(ctx, str(tmp_path / "out"))
    assert spark.read.parquet(paths["rejected_rows"]).count() == 6


@pytest.mark.parametrize("name", ["reopened_alerts", "reopened_kb"])
def test_registered_queries_on_a_reopened_run(spark, name):
    base = {"reopened_alerts": "anomaly_alerts", "reopened_kb": "kb_document"}[name]
    assert _same(entry.queries()[name](spark, SF001), entry.queries()[base](spark, SF001))
