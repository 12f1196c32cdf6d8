"""Properties: pairing equals a brute-force pairing, and results do not
depend on input order or partitioning."""

import random
from collections import Counter

from pyspark.sql import functions as F

from fixtures import custodian_row, exchange_row, internal_row, make_feeds
from settlekit import schemas
from settlekit.config import ReconConfig
import derived_queries as catalog
from settlekit.plans.context import ReconContext
from conftest import SF001

CFG = ReconConfig()


def _brute_force_pairs(internal, custodian, exchange):
    """Python model: twins (same quantity and price) share a seat, a feed's
    leftovers take the seats of two feeds that lack it, the rest pair in order."""
    legs = []
    for rows, q, p in ((internal, 5, 6), (custodian, 5, 6), (exchange, 4, 5)):
        leg = {}
        for r in rows:
            leg.setdefault(r[0], Counter())[(r[q], r[p])] += 1
        legs.append(leg)
    result = Counter()
    for k in {k for leg in legs for k in leg} - {None}:
        seats = {}
        for n, leg in enumerate(legs):
            for (q, p), c in leg.get(k, {}).items():
                for i in range(1, c + 1):
                    seats.setdefault((q, p, i), {})[n] = q
        placed = {s: dict(h) for s, h in seats.items() if len(h) > 1}
        free = {n: sorted(s for s, h in placed.items() if n not in h) for n in range(3)}
        for n in range(3):
            alone = sorted(s for s, h in seats.items() if set(h) == {n})
            for r, s in enumerate(alone):
                seat = free[n][r] if r < len(free[n]) else ("rest", r - len(free[n]))
                placed.setdefault(seat, {})[n] = s[0]
        for h in placed.values():
            result[(k, h.get(0), h.get(1), h.get(2))] += 1
    return result


def test_pairing_matches_brute_force(spark):
    rnd = random.Random(7)
    keys = [f"K{n}" for n in range(12)]
    internal = [internal_row(rnd.choice(keys), qty=rnd.randint(1, 6)) for _ in range(60)]
    custodian = [custodian_row(rnd.choice(keys), qty=rnd.randint(1, 6)) for _ in range(50)]
    exchange = [exchange_row(rnd.choice(keys), qty=rnd.randint(1, 6)) for _ in range(40)]
    for strategy in ("keys", "chain"):
        ctx = ReconContext(spark, make_feeds(spark, internal=internal, custodian=custodian,
                                             exchange=exchange), CFG.with_(strategy=strategy))
        got = Counter((r.trade_id, r.quantity_int, r.quantity_cust, r.quantity_exch)
                      for r in ctx.recon.collect())
        assert got == _brute_force_pairs(internal, custodian, exchange), strategy


def test_results_do_not_depend_on_partitioning(spark):
    feeds = catalog.shared_feeds(spark, SF001)
    shuffled = type(feeds)(*[df.orderBy(F.rand(seed)).repartition(n)
                             for df, (seed, n) in zip(feeds.as_dict().values(),
                                                      [(1, 7), (2, 3), (3, 11)])])
    a = ReconContext(spark, feeds, catalog.DERIVED_FEED_CONFIG)
    b = ReconContext(spark, shuffled, catalog.DERIVED_FEED_CONFIG)
    cols = list(schemas.REPORT_COLUMNS)
    assert a.report.select(cols).exceptAll(b.report.select(cols)).count() == 0
    assert b.report.select(cols).exceptAll(a.report.select(cols)).count() == 0
    for name in ("counterparty_summary", "daily_break_trend", "anomaly_alerts", "kb_document"):
        qa = sorted(map(tuple, catalog.QUERIES[name](a).collect()))
        qb = sorted(map(tuple, catalog.QUERIES[name](b).collect()))
        assert qa == qb, name
