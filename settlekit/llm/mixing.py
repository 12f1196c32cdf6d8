"""Operator 4, mixing sources to target weights by weighted fair queueing.

Documents are shuffled within their source (order of a digest of the id, then
of the id, the size, a digest of the text, and a number for repeated rows).
A document's virtual finish time is the running total of its source's words
at its end, divided by the source's target; a second and third pass over a
source follows its first.  All passes are range-sorted by finish time and cut
where the running total reaches the budget.

Edge cases: a null text has size 0; rows without words have the finish time
of the row before them and take 0 words; a null source is a source of its
own, last in order; equal finish times are broken by source rank and the order
within the source; rows of one doc_id (or null) are told apart and taken each
by itself; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from .common import land, packed, read, unpacked, word_count

WEIGHTS, PASSES = (5, 2, 1), 3
#: the order within a source; no two rows are equal in it
ORDER = ("mix", "doc_id", "size", "mark", "no")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = PASSES) -> DataFrame:
    """source, source_size, rank, target of sizes(source, source_size).

    The budget is the total size.  A target stops at ``most`` times its
    source's size; water-filling: ordered by size / weight, the sources that
    stop are a prefix, and the others share what these leave.  One row per
    source, so the windows are over a dimension table.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(
        W.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    df = ranked.withColumn("weight", w.cast("long"))
    cap = most * F.col("source_size")
    rest = W.orderBy(cap / F.col("weight"), "rank").rowsBetween(0, W.unboundedFollowing)
    done = W.orderBy(cap / F.col("weight"), "rank").rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(done), F.lit(0)))
             / F.sum("weight").over(rest))          # a unit of weight, if those before have stopped
    df = df.withColumn("_level", level).withColumn(
        "_stops", F.col("weight") * F.col("_level") >= cap)
    open_level = F.min(F.when(~F.col("_stops"), F.struct(
        (cap / F.col("weight")).alias("o"), "rank", "_level"))).over(everything)["_level"]
    return df.select("source", "source_size", "rank", F.when(
        F.col("_stops"), cap.cast("double")).otherwise(F.col("weight") * open_level).alias("target"))


def _finish(cum: Column, turn: Column) -> Column:
    return (turn * F.col("source_size") + cum) / F.col("target")


def taken(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """rows(doc_id, source, size, mark, no) -> the same with source_size, target,
    finish, turns.  mark is a digest of the text and no a number of the row's
    own.  rows should be a written table: it is read several times."""
    rows = rows.withColumn("mix", F.md5(F.concat(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("/mix"))))
    # ranges of the whole order, so that many rows of one id or source are dealt to several
    rows = land(rows.repartitionByRange("source", *ORDER).withColumn("_r", F.spark_partition_id()),
                "mix-ranges")
    per = land(rows.groupBy("source", "_r").agg(F.sum("size").alias("_s")), "mix-sums")
    sources = land(targets(per.groupBy("source").agg(F.sum("_s").alias("source_size")), weights, passes),
                   "mix-sources")
    before = W.partitionBy("source").orderBy("_r").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    per = per.withColumn("_before", F.coalesce(F.sum("_s").over(before), F.lit(0)))
    per = per.join(sources.withColumnRenamed("source", "_source"),
                   F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "_s")
    upto = W.partitionBy("source", "_r").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0)
    left = rows.withColumn("_cum", F.sum("size").over(upto))
    per = per.select(F.col("source").alias("_source"), F.col("_r").alias("_r2"), "_before", "source_size",
                     "target", "rank")
    timed = left.join(per, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_r") == F.col("_r2")))
    timed = land(timed.select("doc_id", "source", "size", "source_size", "target", "rank", "mix", "mark", "no",
                              (F.col("_cum") + F.col("_before")).alias("cum")), "mix-timed")
    budget = timed.agg(F.sum("size")).first()[0] or 0
    order = ["finish", "rank", *ORDER]
    turns = F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("turn")
    items = (timed.filter("size > 0").select("*", turns)
             .withColumn("finish", _finish(F.col("cum"), F.col("turn"))))
    items = land(items.select(*order).repartitionByRange(*order).withColumn(
        "slice", F.spark_partition_id()), "mix-items")
    # which slice of the global order holds the cut (one row per slice), then the cut in it
    sums = sorted((r.slice, r.s) for r in items.groupBy("slice").agg(F.sum("size").alias("s")).collect())
    cut, total = None, 0
    for no, s in sums:
        if total + s > budget:
            run = W.partitionBy("slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
            cut = (items.filter(F.col("slice") == no).withColumn("_run", F.sum("size").over(run))
                   .filter(F.col("_run") <= budget - total).select(
                       F.max(F.struct(*order, "_run")).alias("c")).first()["c"])
            if cut is None and no:                      # the cut is the end of the slice before
                last = max((n for n, _ in sums if n < no), default=None)
                cut = None if last is None else items.filter(F.col("slice") == last).select(
                    F.max(F.struct(*order)).alias("c")).first()["c"]
            break
        total += s
    else:
        return timed.withColumn("finish", _finish(F.col("cum"), F.lit(0))).withColumn(
            "turns", F.when(F.col("size") > 0, passes).otherwise(0))
    if cut is None:
        inside = lambda turn: F.lit(False)
    else:
        end = F.struct(*[F.lit(cut[c]).cast(dict(items.dtypes)[c]).alias(c) for c in order])
        inside = lambda turn: F.struct(_finish(F.col("cum"), F.lit(turn)).alias("finish"),
                                       *order[1:]) <= end
    count = sum((inside(t).cast("int") for t in range(passes)), F.lit(0))
    return timed.withColumn("finish", _finish(F.col("cum"), F.lit(0))).withColumn(
        "turns", F.when(F.col("size") > 0, count).otherwise(0))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES,
        text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, finish, turns."""
    rows = packed(docs).withColumn("_no", F.monotonically_increasing_id())
    return taken(_sized(rows, text, source, key), weights, passes).select(
        "doc_id", "size", "source_size", "target", (F.col("turns") * F.col("size")).cast("long").alias("taken"),
        "finish", "turns")


def _sized(rows: DataFrame, text: str, source: str, key: str) -> DataFrame:
    """rows(_row, _no) -> the rows that ``taken`` reads, written."""
    t = F.col(f"_row.`{text}`")
    return land(rows.select(
        F.col(f"_row.`{key}`").alias("doc_id"), F.col(f"_row.`{source}`").alias("source"),
        word_count(t).alias("size"), F.xxhash64(F.coalesce(t, F.lit(""))).alias("mark"),
        F.col("_no").alias("no")), "mix-rows")


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = PASSES,
          text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """The documents of the mix with their own columns, a document taken
    twice in two rows.  Every row has a number of its own, by which its turns
    come back to it."""
    rows = land(packed(docs).withColumn("_no", F.monotonically_increasing_id()), "mix-docs")
    counted = taken(_sized(rows, text, source, key), weights, passes)
    counted = counted.filter("turns > 0").select(F.col("no").alias("_no"), F.col("turns").alias("_turns"))
    return unpacked(rows.join(counted, "_no").select("_row", F.explode(F.sequence(F.lit(1), F.col("_turns")))))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))
