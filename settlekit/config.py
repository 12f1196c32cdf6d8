"""Run parameters of a reconciliation.

Every threshold the break and alert logic uses is a field here, so a query
never hides a constant. The defaults are the reference's values; the query
catalog overrides a few of them for the driver-derived feeds (see
``derived_queries.DERIVED_FEED_CONFIG``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class ReconConfig:
    # "today" for aging: days_outstanding = as_of - trade_date
    as_of: _dt.date = _dt.date(2025, 12, 31)
    # date printed in the knowledge-base overview; None -> as_of
    report_date: _dt.date | None = None
    # |internal - custodian| price difference that still counts as matched
    price_tol: float = 0.01
    # |internal - other| quantity difference that still counts as matched
    qty_tol: float = 0
    # break_value strictly above this is a high-value break
    high_value: float = 1_000_000.0
    # spike threshold = mean + sigma * sample std of the daily break rates
    sigma: float = 2.0
    # one counterparty holding more than this share (%) of breaks -> alert
    concentration_pct: float = 10.0
    # more than this many failed settlements -> alert
    failed_min: int = 100
    # how the three feeds are joined: "keys" (one shuffle per feed, see
    # operators.reconcile) or "chain" (two chained full outer joins)
    strategy: str = "keys"

    def __post_init__(self):
        if not self.concentration_pct > 0:      # bounds the number of concentration alerts
            raise ValueError("concentration_pct must be above 0")

    @property
    def effective_report_date(self) -> _dt.date:
        return self.report_date or self.as_of

    def with_(self, **kw) -> "ReconConfig":
        return replace(self, **kw)
