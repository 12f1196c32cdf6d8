"""Connected components of a link table by large-star / small-star rounds.

Both steps are a group minimum and a join; the table is written to the shared
folder after each round, and only its row count and check sum reach the
driver.  Node ids are of any orderable type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import land


def components(links: DataFrame) -> DataFrame:
    """links(a, b) -> (node, root): every node that has a link, and the least
    node that can be reached from it."""
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    edges = land(links.filter("a <> b").select(hi.alias("u"), lo.alias("v")).distinct(), "components")
    seen = None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = land(small.filter("u <> v").distinct(), "components")
