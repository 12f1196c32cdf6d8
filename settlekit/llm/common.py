"""Helpers shared by the operators of this subpackage.

Operators never print, never collect documents, and keep intermediate tables
as parquet under the session's shared ``spark.checkpoint.dir`` (``land``): a
lost executor re-reads files instead of recomputing the lineage.
"""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Hashable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, remove

#: the six white-space characters of the word rule ``[^\x20\x09-\x0D]+``
SPACES = " \t\n\x0b\x0c\r"


def send_with_tasks(module: str) -> None:
    """Let the module's functions travel to the executors with the tasks, so
    that this package need not be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def kept_by_worker(key: Hashable, make: Callable):
    """What ``make`` builds, once for all tasks of a worker process."""
    kept = sys.modules.setdefault("_settlekit_kept", types.ModuleType("_settlekit_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def land(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and continue from the files.

    What lies behind earlier tables is garbage by now; collecting it lets
    Spark's cleaner delete their shuffle files, which would else stay until
    the driver's heap happens to fill."""
    spark = df.sparkSession
    spark._jvm.System.gc()
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def landed(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read from there, until ``discard``."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._landed_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete what ``landed`` has written, after its last reader."""
    for t in tables:
        remove(t.sparkSession, t._landed_at)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def packed(docs: DataFrame, alias: str = "_row") -> DataFrame:
    """docs as one struct column, so that no column of an operator can clash
    with a column of the table; ``unpacked`` is the inverse."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(alias))


def unpacked(df: DataFrame, alias: str = "_row") -> DataFrame:
    return df.select(f"{alias}.*")


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; null or blank: empty."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(t, r"[ \t-\r]+"))


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def without(text: Column, chars: str) -> Column:
    """The text without the given characters."""
    return F.translate(text, chars, "")
