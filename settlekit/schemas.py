"""Explicit schemas of the three feeds and of the reconciled report.

Feeds are read with these schemas, never with inference (the reference read
CSV with inferred types, so dates stayed strings).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, F, B, I = (T.StringType(), T.DateType(), T.LongType(), T.DoubleType(),
                    T.BooleanType(), T.IntegerType())


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


INTERNAL = _schema(
    ("trade_id", S), ("trade_date", D), ("settlement_date", D), ("ticker", S),
    ("trade_type", S), ("quantity", L), ("price", F), ("counterparty", S),
    ("currency", S), ("notional_value", F), ("source", S), ("trader_id", S),
    ("desk", S), ("booking_time", S),
)

CUSTODIAN = _schema(
    ("trade_id", S), ("trade_date", D), ("settlement_date", D), ("ticker", S),
    ("trade_type", S), ("quantity", L), ("price", F), ("counterparty", S),
    ("currency", S), ("notional_value", F), ("source", S), ("custodian_ref", S),
    ("settlement_status", S),
)

EXCHANGE = _schema(
    ("trade_id", S), ("trade_date", D), ("ticker", S), ("trade_type", S),
    ("quantity", L), ("price", F), ("currency", S), ("notional_value", F),
    ("source", S), ("exchange_ref", S), ("exchange", S), ("execution_venue", S),
)

FEED_SCHEMAS = {"internal": INTERNAL, "custodian": CUSTODIAN, "exchange": EXCHANGE}

# Columns each leg contributes to the reconciled row, with their new names.
INTERNAL_LEG = (
    ("trade_id", "trade_id"), ("trade_date", "trade_date"),
    ("settlement_date", "settlement_date_int"), ("ticker", "ticker"),
    ("trade_type", "trade_type"), ("quantity", "quantity_int"),
    ("price", "price_int"), ("counterparty", "counterparty_int"),
    ("currency", "currency"), ("notional_value", "notional_value_int"),
    ("source", "source"), ("trader_id", "trader_id"), ("desk", "desk"),
    ("booking_time", "booking_time"),
)
CUSTODIAN_LEG = (
    ("trade_id", "trade_id"), ("quantity", "quantity_cust"), ("price", "price_cust"),
    ("counterparty", "counterparty_cust"), ("settlement_date", "settlement_date_cust"),
    ("settlement_status", "settlement_status"), ("custodian_ref", "custodian_ref"),
    ("notional_value", "notional_value_cust"),
)
EXCHANGE_LEG = (
    ("trade_id", "trade_id"), ("quantity", "quantity_exch"), ("price", "price_exch"),
    ("exchange_ref", "exchange_ref"), ("exchange", "exchange"),
    ("execution_venue", "execution_venue"),
)

JOINED_COLUMNS = tuple(
    [n for _, n in INTERNAL_LEG]
    + [n for _, n in CUSTODIAN_LEG[1:]]
    + [n for _, n in EXCHANGE_LEG[1:]]
)
DERIVED_COLUMNS = ("break_type", "is_break", "break_value", "trade_date_dt",
                   "days_outstanding", "aging_bucket")
REPORT_COLUMNS = JOINED_COLUMNS + DERIVED_COLUMNS

# What a leg adds to the joined rows besides the report's columns: whether it
# is there, its own trade date and, for audited feeds, which columns lost their
# value or miss it (bit n: n-th column of the feed) and the row as it came.
LEGS = {"internal": "int", "custodian": "cust", "exchange": "exch"}
PRESENCE_COLUMNS = tuple(f"{c}_{leg}" for leg in LEGS.values() for c in ("has", "day"))
AUDIT = ("lost", "missing", "raw")
AUDIT_COLUMNS = tuple(f"{c}_{leg}" for leg in LEGS.values() for c in AUDIT)
