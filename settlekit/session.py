"""Session helper for tests, the bench and local runs.

Library code never creates a session; it takes the caller's.  This helper
only fills in settings that are unset, so on a cluster the cluster's own
values (shuffle partitions, checkpoint dir, ...) win.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "settlekit") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             # merge small shuffle partitions by size, not up to the core count
             .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint dir (``spark.checkpoint.dir``, the shared
    folder a cluster names).  Only a local-mode session without one (local
    runs, tests) gets a scratch folder; on a cluster an unset dir is an
    error."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return spark.sparkContext.getCheckpointDir() or d
    if not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is invisible to other executors
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    d = tempfile.mkdtemp(prefix="settlekit-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, deleted when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/settlekit-{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def land(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and continue from the files: cuts
    the lineage, so a lost executor re-reads instead of recomputing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that is no longer read."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def put_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file; False if there is one already (it stays as it is)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    except Py4JJavaError as e:
        if "already exists" in str(e.java_exception).lower():
            return False
        raise
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    return True


def get_file(spark: SparkSession, path: str) -> str:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
