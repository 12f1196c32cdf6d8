"""Break classification (C1-C9) as plain column expressions.

Everything here is a Catalyst expression, so the whole classification runs
inside one whole-stage-codegen projection right after the join; there is no
Python in the row path.

Rules kept from the reference:

* a comparison only fires when both sides are present -- a missing leg is
  never a break by itself;
* a custodian status of exactly "Failed" is a break even without an
  internal leg (break_value is then 0);
* tolerances compare in doubles: |100.01 - 100.0| > 0.01 is a break.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import ReconConfig
from ..functions import labels as L

FLAG_COLUMNS = tuple(f"flag_{name}" for name, _ in L.CHECKS)


def _abs_diff_above(a: str, b: str, tol) -> str:
    # NULL when either side is missing -> coalesced to false
    return f"coalesce(abs({a} - {b}) > {tol}, false)"


def flag_exprs(cfg: ReconConfig) -> dict[str, str]:
    """SQL text of the six checks; each is false when a side is missing."""
    qty_tol = f"CAST({float(cfg.qty_tol)!r} AS DOUBLE)"
    price_tol = f"CAST({float(cfg.price_tol)!r} AS DOUBLE)"
    return {
        "flag_quantity": _abs_diff_above("quantity_int", "quantity_cust", qty_tol),
        "flag_price": f"coalesce(abs(price_int - price_cust) > {price_tol}, false)",
        "flag_counterparty": "coalesce(counterparty_int <> counterparty_cust, false)",
        "flag_date": "coalesce(settlement_date_int <> settlement_date_cust, false)",
        "flag_failed": f"coalesce(settlement_status = '{L.FAILED_STATUS}', false)",
        "flag_exchange_qty": _abs_diff_above("quantity_int", "quantity_exch", qty_tol),
    }


def label_expr() -> str:
    """' | '-joined labels of the fired checks in check order, or MATCHED
    (concat_ws skips the NULLs of checks that did not fire)."""
    parts = ", ".join(f"CASE WHEN flag_{name} THEN '{label}' END" for name, label in L.CHECKS)
    joined = f"concat_ws('{L.LABEL_SEPARATOR}', {parts})"
    return f"CASE WHEN {joined} = '' THEN '{L.MATCHED}' ELSE {joined} END"


def labels_expr() -> str:
    """The fired labels as an array, in check order (empty: matched)."""
    parts = ", ".join(f"CASE WHEN flag_{name} THEN '{label}' END" for name, label in L.CHECKS)
    return f"filter(array({parts}), x -> x IS NOT NULL)"


def classify(joined: DataFrame, cfg: ReconConfig) -> DataFrame:
    """Adds the six flags, then break_type, break_types (the labels as an
    array), is_break and break_value."""
    flags = [f"{expr} AS {name}" for name, expr in flag_exprs(cfg).items()]
    with_flags = joined.selectExpr("*", *flags)
    return with_flags.selectExpr("*", f"{label_expr()} AS break_type").selectExpr(
        "*", f"{labels_expr()} AS break_types", f"break_type <> '{L.MATCHED}' AS is_break",
        f"CASE WHEN break_type <> '{L.MATCHED}' THEN coalesce(notional_value_int, CAST(0 AS DOUBLE)) "
        "ELSE CAST(0 AS DOUBLE) END AS break_value")
