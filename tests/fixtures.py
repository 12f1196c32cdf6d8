"""Hand-made three-feed fixtures (our own small tables)."""

import datetime as dt

from settlekit import schemas
from settlekit.sources.feeds import Feeds

D0 = dt.date(2025, 12, 1)


def internal_row(tid, qty=100, price=10.0, cp="CP-A", trade_date=D0, sdate=None, ttype="Buy"):
    sdate = sdate if sdate is not None else (trade_date + dt.timedelta(days=2) if trade_date else None)
    notional = qty * price if qty is not None and price is not None else None
    return (tid, trade_date, sdate, "TKR", ttype, qty, price, cp, "USD", notional, "internal",
            "T1", "Desk", "10:00:00")


def custodian_row(tid, qty=100, price=10.0, cp="CP-A", trade_date=D0, sdate=None, status="Matched"):
    sdate = sdate if sdate is not None else (trade_date + dt.timedelta(days=2) if trade_date else None)
    notional = qty * price if qty is not None and price is not None else None
    return (tid, trade_date, sdate, "TKR", "Buy", qty, price, cp, "USD", notional, "custodian",
            "C-REF", status)


def exchange_row(tid, qty=100, price=10.0, trade_date=D0):
    notional = qty * price if qty is not None and price is not None else None
    return (tid, trade_date, "TKR", "Buy", qty, price, "USD", notional, "exchange", "E-REF",
            "NYSE", "LIT")


def make_feeds(spark, internal=(), custodian=(), exchange=()) -> Feeds:
    return Feeds(spark.createDataFrame(list(internal), schemas.INTERNAL),
                 spark.createDataFrame(list(custodian), schemas.CUSTODIAN),
                 spark.createDataFrame(list(exchange), schemas.EXCHANGE))
