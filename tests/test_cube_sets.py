"""The cube's rows are expanded for few sets, and summaries write no rows."""

from pyspark.sql import functions as F

import derived_queries as catalog
from conftest import SF001
from settlekit.operators import cube


def test_slices_of_few_sets_equal_one_grouping_per_dimension(spark):
    ctx = catalog.context_for(spark, SF001)
    recon = ctx.recon.withColumns({
        "settlement_status": F.when(F.col("settlement_status") == "Failed", None).otherwise(F.col("settlement_status")),
        "trade_type": F.when(F.col("trade_type").startswith("1"), None).otherwise(F.col("trade_type"))}).localCheckpoint()
    agg = cube.row_aggregates(recon, ctx.cfg)
    plan = agg._jdf.queryExecution().optimizedPlan().toString()
    assert max(line.count("], [") for line in plan.splitlines() if "Expand [" in line) == 3      # projections
    got = agg.collect()
    for dims, name in ((["trade_type"], "trade_type"), (["settlement_status"], "status"), (["break_type"], "label"),
                       (["counterparty_int"], "counterparty"), (["trade_date_dt"], "day"), ([], None)):
        want = {(r[0] if dims else None): tuple(r)[len(dims):] for r in recon.groupBy(*dims).agg(
            F.count("*"), F.count("trade_id"), F.sum(F.col("is_break").cast("long")),
            F.coalesce(F.sum(F.when(F.col("is_break"), F.col("break_value")).cast("decimal(38,6)")), F.lit(0)),
            F.sum(F.col("has_exch").cast("long"))).collect()}
        rows = [r for r in got if all(r[f"g_{d}"] == (d != name) for d in cube.ROW_DIMENSIONS)]
        assert {(r[name] if name else None): (r["rows"], r.keyed_rows, r.breaks, r.value_sum or 0, r.exchange_rows)
                for r in rows} == want
        assert len(rows) == len(want)
    assert cube.row_aggregates(recon.limit(0), ctx.cfg).count() == 0


def test_a_summary_does_not_write_the_rows(spark):
    catalog.release_shared()
    for name in ("trade_type_summary", "anomaly_alerts"):
        catalog.run(name, spark, SF001).collect()
    ctx = catalog.shared_context(spark, SF001)
    assert not any("-rows-" in p for p in ctx._written)
    n = catalog.run("break_flags", spark, SF001).count()
    assert any("-rows-" in p for p in ctx._written)
    assert n == ctx.recon.count()
