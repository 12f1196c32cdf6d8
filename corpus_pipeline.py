"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the session's shared folder and hands the files to
the next stage.  All stages but the last return the columns of ``documents``.

1. quality: documents that break a rule go.
2. lines: lines that an earlier line repeats go; a document with no word left goes.
3. near duplicates: one document (that of the least id) of each group stays.
4. mix: sources are taken to their target weights; a document taken twice has two rows.
5. pack: pieces of at most 4096 tokens, with their sequence and offset.

Null ids, null and empty texts, repeated rows and extra columns are treated
as the operators say; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.llm import common, linededup, mixing, neardup, packing, quality


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def lines_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = linededup.without_repeated_lines(docs)
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.one_of_each(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("lines", lines_stage), ("near_duplicates", near_duplicates_stage),
          ("mix", mix_stage), ("pack", pack_stage)]

#: near duplicates, shuffling by digest and byte-pair tokens have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.land(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
