"""Feeds in text files, bound by name.

CSV: every file may have its own column order and further columns.  The
headers are read first (a few kilobytes of each file, several files at a
time), checked against the feed's contract, and the files of one layout are
read together with that layout; the layouts are then selected by name and
united.  A required column that a file's header lacks is an error that names
the file.

JSON (one object per line): keys are bound by name by Spark.  Writers leave
out null fields, so a key counts as missing only when no row has it: the
first lines of the files mostly show all keys; else one scan lists them.

All columns are text; ``feeds.validate`` turns them into their types.
"""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: bytes of a file in which its header, or first rows, must end; files looked at together
HEAD_BYTES, AT_ONCE = 1 << 16, 16
#: the column of records that the reader could not make sense of
MALFORMED = "_malformed_record"


class FeedSchemaError(ValueError):
    """A feed does not have the columns of its contract."""


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The data files under a path, glob or file, as Spark lists them."""
    rows = spark.read.format("binaryFile").load(path).select("path").collect()
    return sorted(r.path for r in rows)


def _head(spark: SparkSession, path: str) -> str:
    """The start of a file, decompressed by the codec of its name."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        raw = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(jvm.org.apache.commons.io.input.BoundedInputStream(
            codec.createInputStream(stream) if codec is not None else stream, HEAD_BYTES)))
    finally:
        stream.close()
    return raw.decode("utf-8-sig", "replace")


def heads(spark: SparkSession, paths: list[str]) -> list[str]:
    with ThreadPoolExecutor(AT_ONCE) as pool:
        return list(pool.map(lambda p: _head(spark, p), paths))


def _first_line(text: str) -> str:
    return text.replace("\r\n", "\n").replace("\r", "\n").split("\n", 1)[0]


def _columns(spark: SparkSession, line: str, options: dict) -> list[str]:
    """A header line cut by the CSV reader itself, under the reader's options."""
    row = spark.createDataFrame([(line,)], "value string").select(F.from_csv(
        "value", ", ".join(f"c{i} string" for i in range(line.count(options.get("sep", ",")) + 1)),
        {k: v for k, v in options.items() if k in ("sep", "quote", "escape", "delimiter")}).alias("h")).first()
    names = [n for n in row.h if n is not None]
    # the first column of a name counts, like in the reference's reader
    return [n if n not in names[:i] else f"{n}.{i}" for i, n in enumerate(names)]


def _check(name: str, wanted: list[str], have: list[str], where: str) -> None:
    missing = [c for c in wanted if c not in have]
    if missing:
        raise FeedSchemaError(f"{name} feed lacks columns {missing} in {where}")


def read_csv(spark: SparkSession, name: str, path: str, wanted: list[str], header: str = "true",
             columns: list[str] | None = None, malformed: bool = False, **options) -> DataFrame:
    """The wanted columns of all files, as text; with ``malformed`` also the
    records with too few or too many fields, as they are in the file.  A file
    without a byte has no rows."""
    files = files_of(spark, path)
    layouts: dict[tuple[str, ...], list[str]] = defaultdict(list)
    if str(header).lower() == "true":
        lines: dict[str, list[str]] = defaultdict(list)
        for f, text in zip(files, heads(spark, files)):
            if text:
                lines[_first_line(text)].append(f)
        for line, at in lines.items():
            have = _columns(spark, line, options)
            _check(name, wanted, have, at[0])
            layouts[tuple(have)] += at
    elif columns is None:
        raise FeedSchemaError(f"{name} feed: a CSV file without header needs columns")
    else:
        _check(name, wanted, columns, "columns")
        layouts[tuple(columns)] = files
    if not any(layouts.values()):
        raise FeedSchemaError(f"{name} feed: no file with a header in {path}")
    out = None
    own = [MALFORMED] if malformed else []
    if malformed:                 # whole records have to be looked at, whatever columns are asked for
        options = options | {"columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    for have, at in layouts.items():
        part = (spark.read.options(**options).option("header", header)
                .schema(T.StructType([T.StructField(c, T.StringType()) for c in [*have, *own]])).csv(at))
        part = part.select(*[F.col(f"`{c}`") for c in [*wanted, *own]])
        out = part if out is None else out.unionByName(part)
    return out


def _json_keys(spark: SparkSession, lines: DataFrame) -> set[str]:
    keys = lines.select(F.explode(F.expr("json_object_keys(value)")).alias("k")).distinct()
    return {r.k for r in keys.collect()}


def read_json(spark: SparkSession, name: str, path: str, wanted: list[str], malformed: bool = False,
              **options) -> DataFrame:
    """The wanted keys of all rows, as text; NULL where a row lacks one.  Files
    without a row are an empty feed."""
    files = files_of(spark, path)
    # whole lines of the files' beginnings; the last may be cut
    shown = [(x,) for text in heads(spark, files) for x in text.split("\n")[:-1] if x.strip()]
    have = _json_keys(spark, spark.createDataFrame(shown, "value string")) if shown else set()
    if not set(wanted) <= have and files:
        lines = spark.read.text(files)
        have = _json_keys(spark, lines)
        if have:
            _check(name, wanted, sorted(have), path)
    if malformed:
        options, wanted = options | {"columnNameOfCorruptRecord": MALFORMED}, [*wanted, MALFORMED]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in wanted])
    return spark.read.options(**options).schema(schema).json(files)
