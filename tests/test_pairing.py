"""Pairing of duplicated keys against a plain version, with groups and keys
that are cut by many slices."""

import random
from collections import Counter, defaultdict

import pytest

import derived_queries as catalog
from conftest import SF001
from fixtures import custodian_row, exchange_row, internal_row, make_feeds
from settlekit.operators import pairing, reconcile


def _plain(feeds):
    """feeds: per feed [(trade_id, q, p, ref)] -> Counter of (trade_id, ref or None per feed)."""
    low = lambda v: (v is not None, v)
    seats, rows = defaultdict(dict), {}
    for n, feed in enumerate(feeds):
        groups = defaultdict(list)
        for t, q, p, ref in feed:
            groups[t, q, p].append(ref)
        for (t, q, p), refs in groups.items():
            for k, ref in enumerate(sorted(refs), 1):
                seats[t, q, p, k][n] = ref
    out = Counter()
    by_key = defaultdict(list)
    for s in sorted(seats, key=lambda s: (s[0], low(s[1]), low(s[2]), s[3])):
        by_key[s[0]].append(seats[s])
    for t, held in by_key.items():
        shared = [h for h in held if len(h) > 1]
        rest = []
        for n in range(len(feeds)):
            free = [h for h in shared if n not in h]
            alone = [h[n] for h in held if list(h) == [n]]
            taken = list(zip(free, alone))
            rest.append(alone[len(taken):])
            rows[n] = taken
        for taken in rows.values():
            for h, _ in taken:
                h["taken"] = True
        joined = [dict(h) for h in shared]
        for h, j in zip(shared, joined):
            j.pop("taken", None)
            for n, taken in rows.items():
                for free, ref in taken:
                    if free is h:
                        j[n] = ref
        for i in range(max(map(len, rest), default=0)):
            joined.append({n: r[i] for n, r in enumerate(rest) if i < len(r)})
        for j in joined:
            out[(t, *[j.get(n) for n in range(len(feeds))])] += 1
    return out


def _feeds(spark, data):
    put = lambda row, at, ref: (*row[:at], ref, *row[at + 1:])
    make = [lambda t, q, p, ref: put(internal_row(t, qty=q, price=p), 11, ref),
            lambda t, q, p, ref: put(custodian_row(t, qty=q, price=p), 11, ref),
            lambda t, q, p, ref: put(exchange_row(t, qty=q, price=p), 9, ref)]
    return make_feeds(spark, *[[m(*r) for r in rows] for m, rows in zip(make, data)])


def _random(rng, keys, sizes, values):
    data = []
    for n in range(3):
        rows = [(rng.choice(keys), rng.choice(values), rng.choice([1.0, 2.5, None]), f"{n}-{i:05d}")
                for i in range(sizes[n])]
        data.append(rows)
    return data


@pytest.fixture(params=[3, 17])
def slices(spark, request):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("keys, sizes, values", [
    (["A"], (40, 25, 60), [1]), (["A", "B"], (60, 45, 50), [1, 2, None]), (list("ABCDEFGH"), (50, 50, 50), [1, 2, 3]),
    (["A"] * 9 + list("BCDEF"), (90, 10, 0), [1, 2]), (["A"], (1, 30, 30), [7])])
def test_pairs_as_the_plain_version(spark, slices, keys, sizes, values):
    rng = random.Random(str((keys, sizes)))
    data = _random(rng, keys, sizes, values)
    frames = list(reconcile.legs(_feeds(spark, data)))
    refs = ["trade_id", "trader_id", "custodian_ref", "exchange_ref"]
    got = Counter(tuple(r) for r in pairing.paired(frames).select(*refs).collect())
    assert got == _plain(data)
    two = Counter(tuple(r) for r in pairing.paired(frames[:2]).select(*refs[:3]).collect())
    assert two == _plain(data[:2])


def test_all_ways_give_the_same_rows(spark, slices):
    """Few and many copies, both join strategies, null keys."""
    rng = random.Random(4)
    for many in (False, True):
        data = _random(rng, ["A", "A", "B"], (12, 9, 10), [1, 2])
        for n in range(3):
            data[n] += [(f"S{i}", 5, 1.0, f"{n}-s{i}") for i in range(5 if many else 60) if rng.random() < .8]
            data[n].append((None, 1, 1.0, f"{n}-null"))
        feeds = _feeds(spark, data)
        refs = ["trade_id", "trader_id", "custodian_ref", "exchange_ref"]
        want = _plain([[r for r in rows if r[0] is not None] for rows in data]) + Counter(
            (None, *[f"{m}-null" if m == n else None for m in range(3)]) for n in range(3))
        for strategy in ("keys", "chain"):
            got = Counter(tuple(r) for r in reconcile.three_way(feeds, strategy).select(*refs).collect())
            assert got == want, (many, strategy)


def test_one_sort_of_the_rows(spark):
    """All groupings come from one range sort: few jobs, whatever the keys."""
    sc = spark.sparkContext
    spark.range(1).count()
    sc.setJobGroup("pairing", "pairing")
    try:
        assert catalog.run("duplicate_key_recon", spark, SF001).count() == 6000
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("pairing")) <= 30
