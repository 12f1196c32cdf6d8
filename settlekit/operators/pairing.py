"""Pairing the copies of duplicated keys (R9, J1, J2) with one sort.

All rows of duplicated keys, of all feeds, become one tagged stream that is
range-sorted once by (trade_id, quantity, price, feed, the feed's columns,
scan position) and written.  A slice (a task's part of that order) may begin
and end within a group, so a hot key, or a third of all rows that are alike,
is spread over many slices.  Then, by windows within the slices:

* each row's number ``k`` within (trade_id, quantity, price) of its feed, and
  how many rows of the group each feed has.  Numbers up to the second largest
  count are held by two feeds or more: these rows are twins and share the seat
  (quantity, price, k).  The rows beyond are left over;
* running counts, within the trade_id, of each feed's leftovers and of the
  seats that a feed lacks and two others share.

Only the groups and trade_ids that a slice's border cuts need more: two of
each per slice at most, so their counts over the slices are small tables that
are broadcast.

A feed's r-th leftover takes the r-th seat that lacks this feed, if there are
so many; the rest are numbered on, and equal numbers of different feeds share
a seat.  Every row has one seat, a seat has one row of a feed at most, and the
joined rows are one group-by over (trade_id, seat).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..session import land, remove, scratch


def _tagged(frames: list[DataFrame], keys: DataFrame | None) -> DataFrame:
    """The rows of the keys: trade_id, q, p, feed, and a struct per feed."""
    structs = [F.struct(*[F.col(c) for c in f.columns if c != "trade_id"]) for f in frames]
    out = None
    for n, f in enumerate(frames):
        qty, price = (next(c for c in f.columns if c.startswith(x)) for x in ("quantity_", "price_"))
        rows = f.where(F.col("trade_id").isNotNull()).select(
            "trade_id", F.col(qty).alias("q"), (F.col(price) + F.lit(0.0)).alias("p"), F.lit(n).alias("feed"),
            *[(s if m == n else F.lit(None).cast(g.select(s).schema[0].dataType)).alias(f"leg{m}")
              for m, (g, s) in enumerate(zip(frames, structs))])
        out = rows if out is None else out.unionByName(rows)
    return out if keys is None else out.join(keys, "trade_id", "left_semi")


def _sorted_slices(tagged: DataFrame, n_frames: int) -> tuple[DataFrame, str]:
    """The stream in order, with ``mid`` (position) and ``slice``; and its path."""
    by = ["trade_id", "q", "p", "feed", *[f"leg{n}" for n in range(n_frames)], "pos"]
    spark = tagged.sparkSession
    path = scratch(spark, "pairing")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tagged.withColumn("pos", F.monotonically_increasing_id()).repartitionByRange(slices, *by).sortWithinPartitions(*by)
     .withColumn("mid", F.monotonically_increasing_id()).withColumn("slice", F.shiftright("mid", 33).cast("int"))
     .drop("pos").write.parquet(path))
    return spark.read.parquet(path), path


_GROUP = ["trade_id", "q", "p"]


def _same(left: str, right: str, columns: list[str]) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def _cut(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The values of ``columns`` that more than one slice has: these stand at the
    slices' ends, so there is less than one per slice."""
    ends = rows.groupBy("slice").agg(F.min(F.struct(*columns)).alias("lo"), F.max(F.struct(*columns)).alias("hi"))
    ends = ends.select("slice", F.explode(F.array("lo", "hi")).alias("v")).groupBy("v").agg(
        F.min("slice").alias("first"), F.max("slice").alias("last"))
    return ends.where("first < last").select("v.*", "first")


def _cut_groups(rows: DataFrame, n_frames: int) -> DataFrame:
    """Per slice and cut group: the feeds' counts in all slices (``all0``..) and
    in earlier ones (``b0``..), and the group's first slice."""
    cut = _cut(rows, _GROUP)
    mine = lambda n: F.count(F.when(F.col("feed") == n, 1))
    runs = rows.select("slice", "feed", *_GROUP).alias("r").join(F.broadcast(cut.alias("c")), _same("r", "c", _GROUP)).groupBy(
        "r.slice", *[f"r.{c}" for c in _GROUP], "c.first").agg(*[mine(n).alias(f"n{n}") for n in range(n_frames)])
    group = W.partitionBy(*_GROUP)                      # a row per slice
    earlier = group.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    return runs.select("slice", *_GROUP, "first", *[F.sum(f"n{n}").over(group).alias(f"all{n}") for n in range(n_frames)],
                       *[F.coalesce(F.sum(f"n{n}").over(earlier), F.lit(0)).alias(f"b{n}") for n in range(n_frames)])


def _numbered(rows: DataFrame, cut: DataFrame, n_frames: int) -> DataFrame:
    """The rows with ``k``, the group's counts ``c0``.. and, over the rows of
    the trade_id in the slice up to the group, the running counts of leftovers
    (``left0``..) and of seats that a feed lacks (``lack0``.., in all ``sum0``..)."""
    feeds = range(n_frames)
    group = W.partitionBy("slice", *_GROUP)
    rows = rows.repartition("slice", "trade_id").withColumns({
        "k": F.row_number().over(W.partitionBy("slice", *_GROUP, "feed").orderBy("mid")).cast("long"),
        # within a group the positions follow the feeds, so this order shares the sort of k
        "nth": F.row_number().over(group.orderBy("feed", "mid")),
        **{f"c{n}": F.count(F.when(F.col("feed") == n, 1)).over(group) for n in feeds}})
    known = [c for c in rows.columns if not c.startswith("c") and c not in ("k", "nth")]
    rows = rows.alias("r").join(F.broadcast(cut.alias("c")), _same("r", "c", ["slice", *_GROUP]), "left")
    earlier = F.coalesce(*[F.when(F.col("feed") == n, F.col(f"b{n}")) for n in feeds], F.lit(0))
    rows = rows.select(*[F.col(f"r.{c}").alias(c) for c in known], (F.col("k") + earlier).alias("k"),
                       ((F.col("nth") == 1) & (F.col("r.slice") == F.coalesce("first", "r.slice"))).alias("head"),
                       *[F.coalesce(f"all{n}", f"r.c{n}").alias(f"c{n}") for n in feeds])
    so_far = W.partitionBy("slice", "trade_id").orderBy("mid").rowsBetween(W.unboundedPreceding, W.currentRow)
    here = W.partitionBy("slice", "trade_id")
    counted = lambda x: F.when(F.col("head"), x).otherwise(0)
    rows = rows.withColumns({**{f"left{n}": F.sum(counted(_left(n, feeds))).over(so_far) for n in feeds},
                             **{f"lack{n}": F.sum(counted(_lack(n, feeds))).over(so_far) for n in feeds},
                             **{f"sum{n}": F.sum(counted(_lack(n, feeds))).over(here) for n in feeds}})
    return rows.drop("head", "mid")


def _others(n: int, feeds) -> list[Column]:
    return [F.col(f"c{m}") for m in feeds if m != n]


def _most(n: int, feeds) -> Column:
    """The largest count of the other feeds."""
    return F.greatest(*_others(n, feeds), F.lit(0).cast("long"))


def _left(n: int, feeds) -> Column:
    """How many rows of the feed no other feed has."""
    return F.greatest(F.col(f"c{n}") - _most(n, feeds), F.lit(0).cast("long"))


def _lack(n: int, feeds) -> Column:
    """How many seats two other feeds share and this one lacks."""
    if len(feeds) < 3:
        return F.lit(0).cast("long")
    return F.greatest(F.least(*_others(n, feeds)) - F.col(f"c{n}"), F.lit(0).cast("long"))


def _cut_keys(rows: DataFrame, n_frames: int) -> DataFrame:
    """Per slice and cut trade_id: the counts of earlier slices, and the lacking
    seats of all slices."""
    feeds = range(n_frames)
    sums = [f"{c}{n}" for c in ("left", "lack") for n in feeds]
    per_slice = rows.join(F.broadcast(_cut(rows, ["trade_id"]).select("trade_id")), "trade_id").groupBy(
        "trade_id", "slice").agg(*[F.max(c).alias(c) for c in sums])
    key = W.partitionBy("trade_id")                     # a row per slice
    prior = key.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    return per_slice.select("slice", "trade_id", *[F.coalesce(F.sum(c).over(prior), F.lit(0)).alias(f"prior_{c}") for c in sums],
                            *[F.sum(f"lack{n}").over(key).alias(f"whole{n}") for n in feeds])


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("-"))


def paired(frames: list[DataFrame], keys: DataFrame | None = None) -> DataFrame:
    """The joined rows of ``keys`` (or of all): trade_id and all frames' columns."""
    spark, feeds = frames[0].sparkSession, range(len(frames))
    legs = [f"leg{n}" for n in feeds]
    rows, ranged = _sorted_slices(_tagged(frames, keys), len(frames))
    rows = land(_numbered(rows, _cut_groups(rows, len(frames)), len(frames)), "numbered")
    remove(spark, ranged)
    rows = rows.alias("r").join(F.broadcast(_cut_keys(rows, len(frames)).alias("c")), _same("r", "c", ["slice", "trade_id"]),
                                "left").drop(F.col("c.slice"), F.col("c.trade_id"))
    own = lambda f: F.coalesce(*[F.when(F.col("feed") == n, f(n)) for n in feeds])
    before = lambda c, n, of: F.col(f"{c}{n}") + F.coalesce(f"prior_{c}{n}", F.lit(0)) - of(n, feeds)
    rows = rows.select("trade_id", "feed", "k", "q", "p", *legs, *[F.col(f"c{n}") for n in feeds],
                       *[before("lack", n, _lack).alias(f"lack{n}") for n in feeds],
                       own(lambda n: _most(n, feeds)).alias("most"),
                       own(lambda n: F.coalesce(f"whole{n}", f"sum{n}")).alias("spare"),
                       own(lambda n: before("left", n, _left)).alias("left"))
    text = lambda kind, *parts: F.concat_ws(":", F.lit(kind), *[_text(x) for x in parts])
    r = F.col("left") + F.col("k") - F.col("most")
    # a seat that lacks feed n is named by its place among these; so do both its
    # holders and the leftover that takes it
    seat = F.when(F.col("k") > F.col("most"), F.when(r <= F.col("spare"), text("l", F.col("feed"), r)).otherwise(
        text("r", r - F.col("spare"))))
    for n in feeds if len(frames) > 2 else ():
        seat = seat.when((F.col("k") > F.col(f"c{n}")) & (F.col("feed") != n),
                         text("l", F.lit(n), F.col(f"lack{n}") + F.col("k") - F.col(f"c{n}")))
    rows = rows.select("trade_id", seat.otherwise(text("t", F.col("q"), F.col("p"), F.col("k"))).alias("seat"), *legs)
    joined = rows.groupBy("trade_id", "seat").agg(*[F.first(c, ignorenulls=True).alias(c) for c in legs])
    return joined.select("trade_id", *[f"leg{n}.*" for n in feeds])
