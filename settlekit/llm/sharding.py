"""Operator 5, sharding: minimax contiguous partition of ordered atomic groups.

Groups are the documents with equal text; a group is never split.  They are
ordered by the digest of their text, and the shards are contiguous runs of
groups.  The smallest feasible shard capacity is binary-searched; a capacity
is checked greedily (fill each shard as far as it goes) with one lookup per
shard in the table of running totals.  Each round tries PROBES capacities at
once, and a lookup reads only the window of the sorted table in which its
answers can lie, so no group list ever reaches the driver.

Edge cases: a null text counts as empty (size 1) and shares the group of the
empty texts; null or repeated doc_ids are rows like any other; with fewer
groups than shards the last shards stay empty; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import land, read

#: capacities tried per round; a group's rows are numbered in SPLIT parts
PROBES, SPLIT, BUCKETS = 24, 1024, 4096


def _running(groups: DataFrame) -> DataFrame:
    """groups(g, n, size) in order of g, with running totals (end_size, end_rows).

    Two levels: BUCKETS ranges of the digest (its first 12 bits: uniform, so
    the ranges are even and their table is bounded), then within each range.
    """
    g = groups.withColumn("_b", F.conv(F.substring(F.hex("g"), 1, 3), 16, 10).cast("int"))
    per = g.groupBy("_b").agg(F.sum("size").alias("_s"), F.sum("n").alias("_n"))
    before = W.orderBy("_b").rowsBetween(W.unboundedPreceding, -1)   # <= BUCKETS rows
    per = per.select("_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_s0"),
                     F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"))
    upto = W.partitionBy("_b").orderBy("g").rowsBetween(W.unboundedPreceding, 0)
    return (g.withColumns({"_s": F.sum("size").over(upto), "_n": F.sum("n").over(upto)})
            .join(per, "_b")
            .select("g", "n", "size", (F.col("_s") + F.col("_s0")).alias("end_size"),
                    (F.col("_n") + F.col("_n0")).alias("end_rows")))


def cuts(totals: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and the running total at which each of
    the shards ends.  ``totals`` is sorted by end_size on disk."""
    head = totals.agg(F.max("end_size"), F.max("size")).first()
    total, largest = head[0] or 0, head[1] or 0
    if not total:
        return 0, [0] * shards

    def greedy(caps: list[int]) -> list[list[int]]:
        """For each capacity, where the shards end when filled greedily."""
        ends: list[list[int]] = [[] for _ in caps]
        for _ in range(shards):
            limits = [(e[-1] if e else 0) + c for e, c in zip(ends, caps)]
            open_ = [i for i, x in enumerate(limits) if x < total]
            found: dict[int, int] = {}
            if open_:
                lo, hi = min(limits[i] for i in open_) - largest, max(limits[i] for i in open_)
                row = totals.filter(F.col("end_size").between(lo, hi)).agg(
                    *[F.max(F.when(F.col("end_size") <= limits[i], F.col("end_size")))
                      for i in open_]).first()
                found = dict(zip(open_, row))
            for i, e in enumerate(ends):
                e.append(found.get(i, total) if i in open_ else total)
        return ends

    low = max(largest, -(-total // shards))           # no smaller capacity can do
    high = -(-total // shards) + largest              # always enough
    best: list[int] = []
    while low < high:
        step = max(1, -(-(high - low) // (PROBES + 1)))
        caps = list(range(low, high, step))
        ends = greedy(caps)
        ok = next((i for i, e in enumerate(ends) if e[-1] >= total), None)
        if ok is None:
            low = caps[-1] + 1
        else:
            high, best = caps[ok], ends[ok]
            low = low if ok == 0 else caps[ok - 1] + 1
    return high, best or greedy([high])[0]


def shard(docs: DataFrame, shards: int = 8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: sizes near equal, equal texts together."""
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = land(docs.select(
        F.col(f"`{key}`").alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), F.unhex(F.md5(t.cast("binary"))).alias("g"),
        ).withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(SPLIT)).cast("int")), "shard-rows")
    # a group's rows go to SPLIT parts by their place in the scan, so that a group of
    # any size is numbered in parallel, whatever its ids
    parts = rows.groupBy("g", "part").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    parts = land(parts, "shard-parts")
    totals = _running(parts.groupBy("g").agg(F.sum("n").alias("n"), F.sum("size").alias("size")))
    totals = land(totals.repartitionByRange("end_size").sortWithinPartitions("end_size"), "shard-totals")
    _, ends = cuts(totals, shards)
    first = totals.agg(*[F.coalesce(F.max(F.when(F.col("end_size") <= e, F.col("end_rows"))), F.lit(0))
                         for e in ends]).first()                       # rows before each cut
    starts = [0, *first[:-1]]
    no, start = F.lit(shards - 1), F.lit(starts[-1])
    for i in reversed(range(shards - 1)):
        no = F.when(F.col("end_size") <= ends[i], i).otherwise(no)
        start = F.when(F.col("end_size") <= ends[i], starts[i]).otherwise(start)
    placed = totals.select("g", no.alias("shard"),
                           (F.col("end_rows") - F.col("n") - start).alias("base"))
    before = W.partitionBy("g").orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # <= SPLIT rows
    parts = (parts.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0)))
             .join(placed, "g")
             .select("g", "part", "shard", (F.col("base") + F.col("skip")).alias("base")))
    nth = F.row_number().over(W.partitionBy("g", "part").orderBy("doc_id"))
    return (rows.withColumn("nth", nth).join(parts, ["g", "part"])
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("base") + F.col("nth") - 1).cast("long").alias("slot")))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
