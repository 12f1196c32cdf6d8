"""Operators 5 and 10: a group of identical rows is numbered in many parts."""

import public_tokenizers
from pyspark.sql import functions as F

from settlekit.llm import packing, sharding


def test_identical_rows_are_spread(spark):
    docs = spark.range(6000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text").alias("text"))
    out = sharding.shard(docs.unionByName(spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")), 2)
    for r in out.groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m")).collect():
        assert r.n == r.d == r.m + 1
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=7)
    length = pieces.first().length
    each = 7 // length
    counts = pieces.groupBy("sequence_id").agg(F.count("*").alias("n"), F.count_distinct("offset").alias("d")).collect()
    assert sum(r.n for r in counts) == 6000 and all(r.n == r.d <= each for r in counts)
    assert len(counts) == -(-6000 // each)
