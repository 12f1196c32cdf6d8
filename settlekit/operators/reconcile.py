"""Three-way join of the internal, custodian and exchange feeds.

Semantics (reference): a full outer equi-join on ``trade_id`` of internal
with custodian, then of that with exchange; duplicated keys multiply
(many-to-many), and every column is suffixed by its leg.

Three physical shapes produce the same rows:

* ``strategy="keys"`` (default).  The set of non-null keys is built from
  the three key columns (a narrow, map-side-deduplicated shuffle), then each
  feed is left-joined to it.  All three joins are on the same attribute,
  so Spark keeps the hash partitioning of the key set: each feed is shuffled
  exactly once and the wide intermediate result is never re-shuffled.
* Bucketed feeds (``sources.bucketed``) are joined without any shuffle.
* ``strategy="chain"``.  The literal two full outer joins.  The second join
  is on ``coalesce(i.trade_id, c.trade_id)``, which hides the partitioning,
  so the whole first-join result is shuffled again.

Rows whose ``trade_id`` is NULL never match anything (SQL equality, not the
pandas null-equals-null rule: matching nulls would emit all pairs among
them).  They are kept as one-legged rows and are appended without any
shuffle, so a feed full of null keys does not create a hot partition.

Duplicated keys.  The copies of a key are paired, not multiplied, so every
input row appears in exactly one output row and a key held by a third of all
rows cannot explode into the product of its copies:

1. Exact twins first: rows of one (trade_id, quantity, price), which all
   feeds have, are numbered in each feed; equal numbers share a seat.
2. A row whose seat no other feed holds is a leftover.  A feed's leftovers
   take, in one shared order, the seats of two feeds that lack this feed;
   further leftovers are paired with those of the other feeds in order.

``operators.pairing`` does this with one range sort of the rows of duplicated
keys.  Whether any key is duplicated is checked first (one pass over the three
key columns); unique-key feeds take the plain plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..session import land
from ..sources.bucketed import BucketedFeeds, whole
from ..sources.feeds import Feeds
from .pairing import paired


def _leg(df: DataFrame, mapping, leg: str) -> DataFrame:
    side = [F.lit(True).alias(f"has_{leg}"), F.col("trade_date").alias(f"day_{leg}")]
    if f"_{schemas.AUDIT[0]}" in df.columns:
        side += [F.col(f"_{c}").alias(f"{c}_{leg}") for c in schemas.AUDIT]
    return df.select([F.col(src).alias(dst) for src, dst in mapping] + side)


def legs(feeds: Feeds) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (_leg(feeds.internal, schemas.INTERNAL_LEG, "int"),
            _leg(feeds.custodian, schemas.CUSTODIAN_LEG, "cust"),
            _leg(feeds.exchange, schemas.EXCHANGE_LEG, "exch"))


def internal_vs_custodian(feeds: Feeds, cached: list | None = None) -> DataFrame:
    """J1 alone: internal and custodian joined on trade_id (full outer
    semantics), with the same key-set plan and duplicate policy as the
    three-way join."""
    cols = [n for _, n in schemas.INTERNAL_LEG] + [n for _, n in schemas.CUSTODIAN_LEG[1:]]
    if isinstance(feeds, BucketedFeeds):
        if feeds.unique:
            return _bucketed(feeds, 2).select(*cols)
        feeds = whole(feeds)
    return _joined(list(legs(feeds)[:2]), cached, _keys_strategy).select(*cols)


def _keys_strategy(frames: list[DataFrame], keys: DataFrame, split: bool = False) -> DataFrame:
    """Full outer join of any number of feeds: ``keys`` (distinct,
    hash-partitioned, none of them twice in a feed), then one left join per feed
    on the same attribute.  Rows of other keys find no partner and stay out."""
    tid = F.col("trade_id")
    keyed = keys
    for f in frames:
        keyed = keyed.join(f.where(tid.isNotNull()), "trade_id", "left")
    orphans = frames[0].where(tid.isNull())
    for f in frames[1:]:
        orphans = orphans.unionByName(f.where(tid.isNull()), allowMissingColumns=True)
    return keyed.unionByName(orphans, allowMissingColumns=True)


def _chain_strategy(frames: list[DataFrame], keys: DataFrame, split: bool = False) -> DataFrame:
    """Two full outer joins of the feeds' rows with these keys, or none."""
    if split:                                       # the feeds have other keys too
        frames = [f.where(F.col("trade_id").isNull()).unionByName(f.join(keys, "trade_id", "left_semi")) for f in frames]
    i, c, e = frames
    merged = lambda a, b: F.coalesce(F.col(f"{a}.trade_id"), F.col(f"{b}.trade_id")).alias("trade_id")
    ic = i.alias("i").join(c.alias("c"), F.col("i.trade_id") == F.col("c.trade_id"), "full_outer")
    ic = ic.select(merged("i", "c"),
                   *[F.col(f"i.{n}") for n in i.columns if n != "trade_id"],
                   *[F.col(f"c.{n}") for n in c.columns if n != "trade_id"])
    ice = ic.alias("ic").join(e.alias("e"), F.col("ic.trade_id") == F.col("e.trade_id"), "full_outer")
    return ice.select(merged("ic", "e"),
                      *[F.col(f"ic.{n}") for n in ic.columns if n != "trade_id"],
                      *[F.col(f"e.{n}") for n in e.columns if n != "trade_id"])


def key_table(*frames: DataFrame) -> DataFrame:
    """One row per non-null key with its number of rows in each feed
    (``n0``, ``n1``, ...): one aggregation of the key columns, partial
    counts on the map side, so a hot key is one row per task before the
    shuffle.  Hash-partitioned on trade_id."""
    tagged = frames[0].select("trade_id", F.lit(0).alias("feed"))
    for n, f in enumerate(frames[1:], start=1):
        tagged = tagged.unionByName(f.select("trade_id", F.lit(n).alias("feed")))
    per_feed = [F.sum(F.when(F.col("feed") == n, 1).otherwise(0)).alias(f"n{n}")
                for n in range(len(frames))]
    return tagged.where(F.col("trade_id").isNotNull()).groupBy("trade_id").agg(*per_feed)


def _twice(n_frames: int) -> Column:
    """A key that one feed has more than once."""
    return F.greatest(*[F.col(f"n{n}") for n in range(n_frames)]) > 1


def duplicated_keys(*frames: DataFrame) -> DataFrame:
    """Keys held by more than one row of the same feed."""
    return key_table(*frames).where(_twice(len(frames))).select("trade_id")


def number(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 1..n within ``group`` in ``order``, computed without
    putting a group into one task.

    The rows are range-partitioned and positioned once and written under the
    checkpoint dir; the per-slice counts and the final numbering both read
    that file, so positions cannot differ between two evaluations (and a lost
    executor re-reads instead of re-deriving).  Rows that are equal in group
    and order are told apart by their scan position, so even a group of
    identical rows splits over many tasks."""
    by = [*group, *[c for c in order if c not in group], "_pos"]
    ranged = land(df.withColumn("_pos", F.monotonically_increasing_id())
                  .repartitionByRange(*by).sortWithinPartitions(*by)
                  .withColumn("_mid", F.monotonically_increasing_id())
                  .withColumn("_slice", F.shiftright("_mid", 33)).drop("_pos"), "copies")
    # one row per group and slice: bounded by the number of partitions per group
    slices = ranged.groupBy(*group, "_slice").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_lo"))
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in [*group, "_slice"]]
    out = ranged.alias("r").join(slices.alias("s"), same)
    return out.select(*[F.col(f"r.{c}").alias(c) for c in df.columns],
                      (F.col("_off") + F.col("_mid") - F.col("_lo") + 1).cast("long").alias(name))


def _joined(frames: list[DataFrame], cached: list | None, join) -> DataFrame:
    """The frames joined on trade_id: ``join(frames, keys)`` for the keys that no
    feed holds twice, and the paired copies of the others.  Where most rows
    are copies, all are paired (the same result): the joins would not pay.

    The key table is persisted (the caller owns ``cached`` and releases it
    once the joined rows are stored): the duplicate check is a sum over it
    and the joins reuse it and its hash partitioning instead of aggregating
    the keys a second time."""
    feeds = range(len(frames))
    keys = key_table(*frames).persist()
    if cached is not None:
        cached.append(keys)
    twice, rows = _twice(len(frames)), sum((F.col(f"n{n}") for n in feeds), F.lit(0))
    copies, total = keys.agg(F.sum(F.when(twice, rows)), F.sum(rows)).first()
    if not copies:
        return join(frames, keys.select("trade_id"))
    if 2 * copies > total:
        out = paired(frames)
        for f in frames:
            out = out.unionByName(f.where(F.col("trade_id").isNull()), allowMissingColumns=True)
        return out
    return join(frames, keys.where(~twice).select("trade_id"), split=True).unionByName(
        paired(frames, keys.where(twice).select("trade_id")))


def _bucketed(feeds: BucketedFeeds, n_frames: int = 3) -> DataFrame:
    """Full outer join of bucketed feeds without a shuffle, in parts that keep
    the buckets of their left side: the keys of the first feed, those that only
    the others have, and so on."""
    frames, out = list(legs(feeds)[:n_frames]), None
    for n, first in enumerate(frames):
        part = first
        for earlier in frames[:n]:
            part = part.join(earlier.select("trade_id"), "trade_id", "left_anti")
        for later in frames[n + 1:]:
            part = part.join(later, "trade_id", "left")
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    for frame in legs(feeds.keyless)[:n_frames]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def three_way(feeds: Feeds, strategy: str = "keys", cached: list | None = None) -> DataFrame:
    """J1 + J2: the 26 joined columns of the reconciliation report, then which
    legs are there with their trade dates, and the audit columns of the legs
    whose feeds have them.  Bucketed feeds without duplicated keys are joined
    bucket by bucket, whatever the strategy."""
    if strategy not in ("keys", "chain"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    join = _keys_strategy if strategy == "keys" else _chain_strategy
    if isinstance(feeds, BucketedFeeds) and feeds.unique:
        out = _bucketed(feeds)
    else:
        feeds = whole(feeds) if isinstance(feeds, BucketedFeeds) else feeds
        out = _joined(list(legs(feeds)), cached, join)
    return out.select(*schemas.JOINED_COLUMNS, *side_columns(out))


def side_columns(joined: DataFrame) -> list[Column]:
    """Presence as true or false, trade dates, and audit columns if there are any."""
    return [F.coalesce(c, F.lit(False)).alias(c) if c.startswith("has_") else F.col(c)
            for c in (*schemas.PRESENCE_COLUMNS, *schemas.AUDIT_COLUMNS) if c in joined.columns]
