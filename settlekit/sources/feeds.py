"""The three trade feeds: reading them from storage and cleaning them.

``Feeds`` is a plain triple of DataFrames; every operator downstream takes
one and stays lazy.  Reading never infers a schema.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from . import textfeeds
from .textfeeds import MALFORMED, FeedSchemaError


@dataclass(frozen=True)
class Feeds:
    internal: DataFrame
    custodian: DataFrame
    exchange: DataFrame

    def as_dict(self) -> dict[str, DataFrame]:
        return {"internal": self.internal, "custodian": self.custodian,
                "exchange": self.exchange}


#: fixed values: texts that CSV readers of the reference take as missing
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _clean(raw: DataFrame, field: T.StructField, null_tokens: bool) -> Column:
    """A column in its contract type; a value that cannot be read, and a
    number that is none (NaN), is NULL."""
    c = F.col(f"`{field.name}`")
    if null_tokens and isinstance(raw.schema[field.name].dataType, T.StringType):
        c = F.when(~c.isin(*NULL_TOKENS), c)
    if raw.schema[field.name].dataType != field.dataType:
        c = c.try_cast(field.dataType)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        c = F.nanvl(c, F.lit(None).cast(field.dataType))
    return c.alias(field.name)


def _wanted(feed: DataFrame, name: str) -> list[T.StructField]:
    wanted = schemas.FEED_SCHEMAS[name].fields
    missing = [f.name for f in wanted if f.name not in set(feed.columns)]
    if missing:
        raise FeedSchemaError(f"{name} feed lacks columns {missing}")
    return wanted


def validate(feed: DataFrame, name: str, null_tokens: bool = False, audit: bool = False) -> DataFrame:
    """Fail early when a required column is missing; bring the rest to the
    contract types.  One unreadable value costs that value, not the run.
    Extra columns are kept out (column pruning starts here).

    ``audit`` adds, for the joined rows to carry: ``_lost`` (bit n: the n-th
    column's value could not be read), ``_missing`` (bit n: it is NULL now) and
    ``_raw`` (the row as it came, as JSON, where a value or the key was lost or
    the reader found the record malformed)."""
    fields = _wanted(feed, name)
    clean = [_clean(feed, f, null_tokens) for f in fields]
    if not audit:
        return feed.select(clean)
    malformed = F.col(MALFORMED) if MALFORMED in feed.columns else F.lit(None).cast("string")
    bits = lambda hit: sum((F.when(hit(c, f), F.lit(1 << n)).otherwise(F.lit(0)).cast("long")
                            for n, (c, f) in enumerate(zip(clean, fields))), F.lit(0).cast("long"))
    lost = bits(lambda c, f: c.isNull() & F.col(f"`{f.name}`").isNotNull())
    raw = F.coalesce(malformed, F.to_json(F.struct(*[F.col(f"`{f.name}`") for f in fields])))
    bad = (F.col("_lost") != 0) | F.col("trade_id").isNull() | F.col("_malformed")
    return (feed.select(*clean, lost.alias("_lost"), bits(lambda c, f: c.isNull()).alias("_missing"),
                        raw.alias("_raw"), malformed.isNotNull().alias("_malformed"))
            .withColumn("_raw", F.when(bad, F.col("_raw"))).drop("_malformed"))


def losses(rows: DataFrame) -> DataFrame:
    """S3: ``feed_losses`` of all audited feeds from the joined rows, without
    reading a feed: the rows are counted by their bits, and the few patterns
    of bits found are spread over the columns."""
    out = None
    for name, leg in _audited(rows):
        fields = schemas.FEED_SCHEMAS[name].fields
        counts = rows.where(f"has_{leg}").groupBy(F.col(f"lost_{leg}").alias("lost"), F.col(f"missing_{leg}").alias("missing")
                                                  ).agg(F.count(F.lit(1)).alias("n"))
        hit = lambda c, n: F.coalesce(F.sum(F.when(F.col(c).bitwiseAND(1 << n) != 0, F.col("n"))),
                                      F.lit(0)).cast("long")
        spread = counts.agg(*[hit(c, n).alias(f"{c}_{n}") for n in range(len(fields)) for c in ("lost", "missing")])
        values = ", ".join(f"'{f.name}', lost_{n}, missing_{n}" for n, f in enumerate(fields))
        part = spread.selectExpr(f"'{name}' AS feed", f"stack({len(fields)}, {values}) AS (column_name, lost, missing)")
        out = part if out is None else out.unionByName(part)
    return out


def rejects(rows: DataFrame) -> DataFrame:
    """The feed rows that lost something, from the joined rows: feed,
    trade_id, the columns that lost their value, and the row as it came."""
    out = None
    for name, leg in _audited(rows):
        columns = [F.when(F.col(f"lost_{leg}").bitwiseAND(1 << n) != 0, F.lit(f.name))
                   for n, f in enumerate(schemas.FEED_SCHEMAS[name].fields)]
        part = rows.where(F.col(f"raw_{leg}").isNotNull()).select(
            F.lit(name).alias("feed"), "trade_id", F.array_compact(F.array(*columns)).alias("lost_columns"),
            F.col(f"raw_{leg}").alias("raw"))
        out = part if out is None else out.unionByName(part)
    return out


def _audited(rows: DataFrame) -> list[tuple[str, str]]:
    legs = [(name, leg) for name, leg in schemas.LEGS.items() if f"lost_{leg}" in rows.columns]
    if not legs:
        raise FeedSchemaError("no feed of these rows was read with audit")
    return legs


def feed_losses(feed: DataFrame, name: str, null_tokens: bool = False) -> DataFrame:
    """One row per column: how many values ``validate`` turns into NULL
    (``lost``) and how many are NULL afterwards (``missing``); the rows
    without a trade_id are its ``missing`` count.  One pass over the feed."""
    fields = _wanted(feed, name)
    counts = []
    for f in fields:
        after = _clean(feed, f, null_tokens)
        counts += [F.count(F.when(after.isNull() & F.col(f"`{f.name}`").isNotNull(), 1)).alias(f"lost_{f.name}"),
                   F.count(F.when(after.isNull(), 1)).alias(f"missing_{f.name}")]
    rows = ", ".join(f"'{f.name}', lost_{f.name}, missing_{f.name}" for f in fields)
    return feed.agg(*counts).selectExpr(f"stack({len(fields)}, {rows}) AS (column_name, lost, missing)").select(
        F.lit(name).alias("feed"), "column_name", "lost", "missing")


def read_raw(spark: SparkSession, name: str, path: str, fmt: str = "parquet", audit: bool = False,
             **options) -> DataFrame:
    """A feed as it is stored, its columns bound by name; CSV and JSON columns
    as text, with the malformed records if ``audit``."""
    wanted = [f.name for f in schemas.FEED_SCHEMAS[name].fields]
    if fmt == "csv":
        return textfeeds.read_csv(spark, name, path, wanted, malformed=audit, **options)
    if fmt == "json":
        return textfeeds.read_json(spark, name, path, wanted, malformed=audit, **options)
    return spark.read.format(fmt).options(**options).load(path)


def read_feed(spark: SparkSession, name: str, path: str, fmt: str = "parquet", audit: bool = False,
              **options) -> DataFrame:
    """Read one feed with its declared schema.

    ``fmt`` is any DataFrameReader format (parquet, csv, json, orc, or a
    table format whose package is on the classpath).  CSV files are read by
    their headers (``header="false"`` needs ``columns``, the names in file
    order); the null tokens of the reference's reader are NULL.  A required
    column that no file row can give raises ``FeedSchemaError``.  ``audit``:
    see ``validate``.
    """
    return validate(read_raw(spark, name, path, fmt, audit, **options), name, null_tokens=fmt == "csv", audit=audit)


def read_feeds(spark: SparkSession, internal: str, custodian: str, exchange: str,
               fmt: str = "parquet", **options) -> Feeds:
    return Feeds(
        read_feed(spark, "internal", internal, fmt, **options),
        read_feed(spark, "custodian", custodian, fmt, **options),
        read_feed(spark, "exchange", exchange, fmt, **options),
    )
