"""The fact vector: every figure that the composite tables show, in one row
(I1, I3, I5-I9, I13, S8).

One conditional aggregation of the break cube gives the totals and, as sorted
arrays, the cube's counterparties, labels, days, trade types, weekdays and
aging buckets (each bounded by its dimension, like the cube itself).  Spikes,
concentrations, trends, top lists and alerts are then expressions on that row,
so each composite table is one small job: a projection of the vector.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ReconConfig
from ..functions import labels as L
from ..functions.numeric import half_even, pct
from .aging import bucket_ordinal
from .cube import ALL

_RATE = "decimal(12,2)"


def _num(col: Column, digits: int = 0) -> Column:
    return F.format_number(col, digits)


def figures(**values: Column) -> Column:
    """The one message template: ``name=figure; name=figure``."""
    return F.concat_ws("; ", *[F.concat(F.lit(f"{name}="), value) for name, value in values.items()])


def _sorted(dim: str, keep: Column, *fields: Column) -> Column:
    """The cube's groups of a dimension as structs, in the structs' order."""
    return F.sort_array(F.collect_list(F.when((F.col("dim") == dim) & F.col("key").isNotNull() & keep, F.struct(*fields))))


def _names(items: Column, sep: str = ", ") -> Column:
    return F.array_join(F.transform(items, lambda s: s["key"]), sep)


def vector(cube: DataFrame, cfg: ReconConfig) -> DataFrame:
    """One row (also over an empty cube):

    trades, breaks, value; n_<check> (labels); high_value_count, ...;
    ``cps``, ``trade_types``, ``weekdays``, ``patterns``: (less, key, ...) with
    breaks, most breaks first; ``types``: single labels, most first; ``days``:
    (key, rate) by date; ``ages``: (display_order, key, breaks); the rates'
    ``mean_rate``, ``std_rate``, ``threshold``; ``cp_breaks``: breaks that have
    a counterparty."""
    total = lambda c: F.coalesce(F.sum(F.when(F.col("dim") == ALL, F.col(c))), F.lit(0))
    less, some = (-F.col("breaks")).alias("less"), F.col("breaks") > 0
    day = (F.col("dim") == "day") & F.col("key").isNotNull()
    rate = half_even(F.try_divide(F.col("breaks").cast("double"), F.col("keyed_rows").cast("double")) * F.lit(100.0), 2)
    x = F.when(day, rate.cast(_RATE))
    bare = [F.col("key"), F.col("breaks")]
    row = cube.agg(
        total("rows").cast("bigint").alias("trades"), total("breaks").cast("bigint").alias("breaks"),
        total("value").cast("double").alias("value"),
        *[total(f"n_{name}").cast("bigint").alias(f"n_{name}") for name, _ in L.CHECKS],
        *[total(c).cast("bigint").alias(c) for c in ("high_value_count", "aged_count", "failed_count")],
        *[total(c).cast("double").alias(c) for c in ("high_value_total", "aged_value")],
        _sorted("counterparty", F.lit(True), less, *bare, F.col("keyed_rows"), F.col("rows"), F.col("value")).alias("cps"),
        _sorted("trade_type", some, less, *bare).alias("trade_types"),
        _sorted("weekday", some, less, *bare).alias("weekdays"),
        _sorted("label", some, less, *bare).alias("patterns"),
        _sorted("aging", some & (F.col("key") != L.AGING_UNKNOWN), bucket_ordinal(F.col("key")).alias("display_order"),
                *bare).alias("ages"),
        _sorted("day", F.lit(True), F.col("key"), rate.alias("rate")).alias("days"),
        F.count(x).alias("n_days"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"),
        F.coalesce(F.sum(F.when((F.col("dim") == "counterparty") & F.col("key").isNotNull(), F.col("breaks"))),
                   F.lit(0)).alias("cp_breaks"))
    # the mean and sample deviation from exact decimal sums, as in ``trend``
    n = F.col("n_days")
    spread = (n * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
    row = row.withColumns({
        "mean_rate": F.try_divide(F.col("sx").cast("double"), n.cast("double")),
        "std_rate": F.when(n > 1, F.sqrt(F.try_divide(spread, (n * (n - 1)).cast("double")))),
        "types": F.sort_array(F.filter(F.array(*[
            F.struct((-F.col(f"n_{name}")).alias("less"), F.lit(label).alias("key"), F.col(f"n_{name}").alias("count"))
            for name, label in L.CHECKS]), lambda t: t["count"] > 0))})
    return row.withColumns({
        "threshold": F.col("mean_rate") + F.lit(float(cfg.sigma)) * F.col("std_rate"),
        "instances": F.aggregate("types", F.lit(0).cast("bigint"), lambda acc, t: acc + t["count"])})


def match_rate() -> Column:
    return pct(F.col("trades") - F.col("breaks"), F.col("trades"))


def share(count: Column) -> Column:
    """A label's share of all break instances."""
    return pct(count, F.col("instances"))


def top(items: str, n: int = 1) -> Column:
    """The first n of a sorted array that have breaks; for one: its struct, or NULL."""
    if n == 1:
        return F.try_element_at(items, F.lit(1))
    return F.slice(items, 1, n)


def summary_counterparty(s: Column) -> Column:
    """A row of the counterparty summary from a struct of ``cps``."""
    rate = half_even((F.lit(1.0) - s["breaks"].cast("double") / s["rows"].cast("double")) * F.lit(100.0), 1)
    return F.struct(s["key"].alias("counterparty"), s["keyed_rows"].alias("total_trades"), s["breaks"].alias("breaks"),
                    rate.alias("match_rate"), half_even(s["value"], 1).alias("total_break_value"))


def trend() -> Column:
    """Latest day, the one before it (itself, if it is the only one) and the trend word."""
    latest = F.try_element_at("days", F.lit(-1))
    before = F.coalesce(F.try_element_at("days", F.lit(-2)), latest)
    change = latest["rate"] - before["rate"]
    return F.struct(latest["key"].alias("latest_date"), latest["rate"].alias("latest_rate"),
                    before["key"].alias("previous_date"), before["rate"].alias("previous_rate"),
                    F.when(change > 0, F.lit(L.TREND_UP)).when(change < 0, F.lit(L.TREND_DOWN))
                    .when(change.isNotNull(), F.lit(L.TREND_FLAT)).alias("trend"))


def alert_array(cfg: ReconConfig) -> Column:
    """The fired alerts in rule order, as structs with their rank."""
    def alert(severity: str, kind: str, message: Column, dates: Column | None = None,
              counterparty: Column | None = None, count: Column | None = None) -> Column:
        return F.struct(F.lit(severity).alias("severity"), F.lit(kind).alias("alert_type"), message.alias("message"),
                        (F.lit(None) if dates is None else dates).cast("string").alias("dates"),
                        (F.lit(None) if counterparty is None else counterparty).cast("string").alias("counterparty"),
                        (F.lit(None) if count is None else count).cast("bigint").alias("alert_count"))

    def fired(when: Column, one: Column) -> Column:
        return F.when(F.coalesce(when, F.lit(False)), F.array(one)).otherwise(F.slice(F.array(one), 1, 0))
    spikes = F.filter("days", lambda d: d["rate"] > F.col("threshold"))
    high = lambda s: pct(s["breaks"], F.col("cp_breaks")) > F.lit(float(cfg.concentration_pct))
    # at most floor(100 / concentration_pct) counterparties can be above the limit
    concentrated = F.filter("cps", lambda s: (s["breaks"] > 0) & high(s))
    alerts = F.concat(
        fired(F.size(spikes) > 0, alert(
            L.HIGH, L.BREAK_RATE_SPIKE,
            figures(days=F.size(spikes).cast("string"), sigma=F.lit(f"{cfg.sigma:g}"), limit=_num(F.col("threshold"), 1),
                    mean=_num(F.col("mean_rate"), 1)), dates=_names(F.slice(spikes, 1, 5), ","))),
        F.transform(concentrated, lambda s: alert(
            L.MEDIUM, L.COUNTERPARTY_CONCENTRATION,
            figures(counterparty=s["key"], share=_num(pct(s["breaks"], F.col("cp_breaks")), 1),
                    limit=F.lit(f"{cfg.concentration_pct:g}")), counterparty=s["key"])),
        fired(F.col("high_value_count") > 0, alert(
            L.HIGH, L.HIGH_VALUE_BREAKS,
            figures(breaks=_num(F.col("high_value_count")), value=_num(F.col("high_value_total"), 0),
                    limit=F.lit(f"{cfg.high_value:,.0f}")), count=F.col("high_value_count"))),
        fired(F.col("aged_count") > 0, alert(
            L.HIGH, L.AGING_BREAKS, figures(breaks=_num(F.col("aged_count")), value=_num(F.col("aged_value"), 0)),
            count=F.col("aged_count"))),
        fired(F.col("failed_count") > F.lit(cfg.failed_min), alert(
            L.MEDIUM, L.FAILED_SETTLEMENT_VOLUME,
            figures(failed=_num(F.col("failed_count")), limit=F.lit(f"{cfg.failed_min:,}")), count=F.col("failed_count"))))
    return F.transform(alerts, lambda s, i: F.struct((i + 1).alias("alert_rank"), *[s[c].alias(c) for c in (
        "severity", "alert_type", "message", "dates", "counterparty", "alert_count")]))


def display(label: Column) -> Column:
    return F.initcap(F.regexp_replace(label, "_", " "))


def faq_array(cfg: ReconConfig) -> Column:
    """Six question keys and the figures that answer them; needs ``alerts``."""
    worst = summary_counterparty(top("cps"))
    listed = lambda items, f: F.array_join(F.transform(items, f), ", ")
    answers = [
        ("match_rate", F.lit(True), figures(match_rate=_num(match_rate(), 1), breaks=_num(F.col("breaks")),
                                            trades=_num(F.col("trades")))),
        ("top_counterparty", F.size("cps") > 0, figures(
            counterparty=worst["counterparty"], breaks=_num(worst["breaks"]), value=_num(worst["total_break_value"], 0))),
        ("common_break_types", F.lit(True), figures(types=listed(top("types", 3), lambda t: F.concat(
            display(t["key"]), F.lit(" ("), _num(t["count"]), F.lit(")"))))),
        ("high_value_breaks", F.lit(True), figures(breaks=_num(F.col("high_value_count")),
                                                   limit=F.lit(f"{cfg.high_value:,.0f}"))),
        ("breaks_by_age", F.lit(True), figures(ages=listed(F.col("ages"), lambda a: F.concat(
            a["key"], F.lit(": "), _num(a["breaks"]))))),
        ("alerts", F.lit(True), figures(alerts=F.size("alerts").cast("string"), first=F.array_join(F.transform(
            F.slice("alerts", 1, 3), lambda s: F.concat(F.lit("["), s["severity"], F.lit("] "), F.regexp_replace(
                s["alert_type"], "_", " "))), " "))),
    ]
    rows = F.array(*[F.when(have, F.struct(F.lit(n).alias("faq_rank"), F.lit(q).alias("question"), a.alias("answer")))
                     for n, (q, have, a) in enumerate(answers, 1)])
    return F.filter(rows, lambda r: r.isNotNull())
