"""Feeds written once, bucketed and sorted by trade_id, for joins without a
shuffle (J1, J2).

All feeds have the same number of buckets, so equal keys lie in equal buckets
and Spark joins bucket by bucket.  Rows without a key match nothing; they are
kept beside the buckets, or else one bucket would hold them all.  Each task
writes one bucket, as one file.  ``open_bucketed`` registers the written tables
in another session.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..session import get_file, put_file
from .feeds import Feeds

_NOTE = "_bucketed.json"


@dataclass(frozen=True)
class BucketedFeeds(Feeds):
    """Feeds whose rows with a key are bucketed tables; ``keyless`` has the
    others.  ``unique``: no feed holds a key twice."""
    keyless: Feeds
    buckets: int
    unique: bool
    path: str


def _register(spark: SparkSession, path: str, name: str, schema: T.StructType, buckets: int) -> DataFrame:
    """The bucketed files as a table of this session."""
    table = f"settlekit_{name}_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (trade_id) SORTED BY (trade_id) "
              f"INTO {buckets} BUCKETS LOCATION '{path}/{name}'")
    return spark.table(table)


def write_bucketed(feeds: Feeds, path: str, buckets: int) -> BucketedFeeds:
    """Write the feeds below ``path`` (a new folder).  ``buckets``: so many that
    one bucket of the widest feed fits in a task's memory."""
    spark, path = feeds.internal.sparkSession, path.rstrip("/")
    for name, df in feeds.as_dict().items():
        keyed = F.col("trade_id").isNotNull()
        table = f"settlekit_{name}_{uuid.uuid4().hex}"
        (df.where(keyed).repartition(buckets, "trade_id").write.bucketBy(buckets, "trade_id").sortBy("trade_id")
         .format("parquet").option("path", f"{path}/{name}").saveAsTable(table))
        spark.sql(f"DROP TABLE {table}")               # the files stay
        df.where(~keyed).write.parquet(f"{path}/{name}-keyless")
    note = {"buckets": buckets, "unique": True, "schemas": {n: df.schema.jsonValue() for n, df in feeds.as_dict().items()}}
    tables = [_register(spark, path, n, df.schema, buckets) for n, df in feeds.as_dict().items()]
    twice = [t.groupBy("trade_id").count().where("count > 1") for t in tables]      # bucket by bucket
    note["unique"] = all(t.isEmpty() for t in twice)
    put_file(spark, f"{path}/{_NOTE}", json.dumps(note))
    return open_bucketed(spark, path)


def open_bucketed(spark: SparkSession, path: str) -> BucketedFeeds:
    """Feeds that ``write_bucketed`` has written whole."""
    path = path.rstrip("/")
    note = json.loads(get_file(spark, f"{path}/{_NOTE}"))
    kinds = {n: T.StructType.fromJson(note["schemas"][n]) for n in schemas.LEGS}
    tables = [_register(spark, path, n, kinds[n], note["buckets"]) for n in schemas.LEGS]
    keyless = Feeds(*[spark.read.schema(kinds[n]).parquet(f"{path}/{n}-keyless") for n in schemas.LEGS])
    return BucketedFeeds(*tables, keyless=keyless, buckets=note["buckets"], unique=note["unique"], path=path)


def whole(feeds: BucketedFeeds) -> Feeds:
    """All rows, for plans that do not use the buckets."""
    return Feeds(*[a.unionByName(b) for a, b in zip(feeds.as_dict().values(), feeds.keyless.as_dict().values())])
