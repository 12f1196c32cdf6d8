"""Sinks (S4-S8): the report, the breaks, the summaries, alerts and the
knowledge base.

Row-level outputs are written in parallel (one file per task), optionally
partitioned by a low-cardinality column such as the trade date.  Only the
small, bounded summary tables are coalesced to one file, because their
consumers expect a single CSV.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import alerts, insights, summaries


def write_rows(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: tuple[str, ...] = (), **options) -> str:
    """A row-level table, written by every task in parallel."""
    w = df.write.mode(mode).format(fmt).options(**options)
    if fmt == "csv":
        w = w.option("header", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def _plain(df: DataFrame) -> DataFrame:
    """Doubles as plain fixed-point text (one decimal at least), never 1.0E7."""
    def text(c: str, kind: str) -> Column:
        x = F.col(f"`{c}`")
        if kind != "double":
            return x
        exact = F.regexp_replace(x.cast("decimal(38,6)").cast("string"), "0{1,5}$", "")
        return exact.alias(c)
    return df.select([text(c, kind) for c, kind in df.dtypes])


def write_small_csv(df: DataFrame, path: str, order: tuple = (), mode: str = "overwrite", **options) -> str:
    """A small summary table as one CSV file with a header, its rows in
    ``order``.  Callers pass only tables bounded by a dimension
    (counterparties, days, buckets, labels), never row-level data."""
    out = df.coalesce(1)
    if order:
        out = out.sortWithinPartitions(*order)
    _plain(out).write.mode(mode).option("header", "true").options(**options).csv(path)
    return path


def alert_objects(alerts_: DataFrame) -> DataFrame:
    """The alerts with the keys of the contract, ``dates`` as an array."""
    return alerts_.orderBy("alert_rank").select(
        "severity", F.col("alert_type").alias("type"), "message", F.split("dates", ",").alias("dates"),
        "counterparty", F.col("alert_count").alias("count"))


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite", **options) -> str:
    """JSON lines (one object per alert, absent fields left out)."""
    df.coalesce(1).write.mode(mode).options(**options).json(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """A one-column string frame as a text file (the KB JSON)."""
    df.coalesce(1).write.mode(mode).text(path)
    return path


def write_tables(ctx, folder: str, fmt: str = "parquet", **options) -> dict[str, tuple]:
    """Every output of a run below ``folder``, the way the reference lays them
    out, and the aggregates that a later run starts from: name -> (frame,
    format, reader options).  The joined rows are written once and everything
    else reads them; ``options`` go to the writer of the two row-level tables."""
    ctx.materialize()
    cube, cfg = ctx.cube, ctx.cfg
    most = F.desc("breaks")
    csv = {"header": "true"}
    rows = (fmt, csv if fmt == "csv" else {})
    out = {}

    def done(name: str, df: DataFrame, how: tuple, write, *args, **kw) -> None:
        write(df, f"{folder}/{name}", *args, **kw)
        out[name] = (df, *how)
    done("reconciliation_report", ctx.report, rows, write_rows, fmt, **options)
    done("settlement_breaks", ctx.settlement_breaks, rows, write_rows, fmt, **options)
    for name, df, order in (
            ("counterparty_summary", ctx.counterparty_summary, (most, "counterparty_int")),
            ("trade_type_summary", summaries.trade_type_summary(cube), (most, "trade_type")),
            ("daily_break_trend", ctx.daily, ("trade_date_str",)),
            ("aging_summary", summaries.aging_summary(cube), ("aging_bucket",))):
        done(name, df, ("csv", csv), write_small_csv, order)
    done("anomaly_alerts", alert_objects(alerts.anomaly_alerts(cube, cfg)), ("json", {}), write_json_lines)
    done("knowledge_base", insights.kb_document(cube, cfg).select(
        F.col("kb_json").alias("value")), ("text", {}), write_text)
    if ctx.audited:
        done("rejected_rows", ctx.rejected_rows, ("parquet", {}), write_rows)
    done("row_aggregates", ctx.aggregates, ("parquet", {}), write_rows)
    done("break_cube", cube, ("parquet", {}), write_rows)
    return out


def write_all(ctx, out_dir: str, fmt: str = "parquet", **options) -> dict[str, str]:
    """Publish every output of a run (``plans.runs``): name -> path of the table."""
    return ctx.publish(out_dir, fmt, **options).paths
