"""Trade feeds derived from orders, customer and nation (FIXTURES.md, section
3), for the registered queries, the bench and the tests; not part of the
library.  Deterministic arithmetic on o_orderkey only, so the SQL oracle can
rebuild the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from settlekit.functions.labels import FAILED_STATUS
from settlekit.schemas import FEED_SCHEMAS
from settlekit.session import land
from settlekit.sources.feeds import Feeds


def _zpad(expr: str, width: int) -> str:
    """SQL text: non-negative integer zero-padded to at least `width` digits
    (printf '%0Nd'; plain lpad would truncate longer numbers).  Cheaper per
    row than format_string, which goes through java.util.Formatter."""
    return (f"CASE WHEN ({expr}) < {10 ** width} THEN lpad(CAST({expr} AS STRING), {width}, '0') "
            f"ELSE CAST({expr} AS STRING) END")


def derive_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Explicit read schemas: o_orderdate is a wall-clock timestamp (parquet
    # isAdjustedToUTC=false); reading it as timestamp_ntz keeps the trade
    # date independent of the session time zone and of schema inference.
    orders = spark.read.schema(
        "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING").parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.schema("c_custkey BIGINT, c_nationkey INT").parquet(
        f"{sf_dir}/customer.parquet")
    nation = spark.read.schema("n_nationkey INT, n_name STRING").parquet(f"{sf_dir}/nation.parquet")
    # orders -> customer first: customer's own scan size is what Catalyst
    # checks against the broadcast threshold (a customer-nation join on that
    # side would be estimated as the product of both sizes and force a
    # sort-merge join at every scale).  At scale this is a shuffle join.
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
              .join(nation, customer.c_nationkey == nation.n_nationkey, "left"))
    return joined.selectExpr(
        "o_orderkey AS k",
        "o_orderkey % 101 AS m",
        f"concat('TRD-', {_zpad('o_orderkey', 7)}) AS trade_id",
        "CAST(o_orderdate AS DATE) AS trade_date",
        "date_add(CAST(o_orderdate AS DATE), 2) AS settlement_date",
        f"concat('TKR', {_zpad('o_orderkey % 25', 2)}) AS ticker",
        "o_orderpriority AS trade_type",
        "CAST(100 * (1 + o_orderkey % 7) AS BIGINT) AS quantity",
        "CAST(floor(o_totalprice * 100 / (100 * (1 + o_orderkey % 7))) AS DOUBLE) / 100 AS price",
        "n_name AS counterparty",
        f"concat('CUR-', CAST(o_orderkey % 4 AS STRING)) AS currency",
    )


NOTIONAL = "quantity * price AS notional_value"


def derive_feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    """The joined base is written once; the feeds are row-local projections of it."""
    base = land(derive_base(spark, sf_dir), "feed-base")

    internal = base.where("m NOT IN (20, 40)").selectExpr(
        "trade_id", "trade_date", "settlement_date", "ticker", "trade_type",
        "quantity", "price", "counterparty", "currency", NOTIONAL,
        "'internal' AS source",
        f"concat('TR', {_zpad('k % 40', 3)}) AS trader_id",
        f"concat('DESK-', CAST(k % 3 AS STRING)) AS desk",
        f"concat_ws(':', {_zpad('9 + k % 8', 2)}, {_zpad('(k * 7) % 60', 2)}, "
        f"{_zpad('(k * 13) % 60', 2)}) AS booking_time",
    )

    custodian = base.where("m <> 41").selectExpr(
        "k", "trade_id", "trade_date", "ticker", "trade_type", "currency",
        "CASE WHEN m IN (9, 10) THEN date_add(settlement_date, CAST(1 + k % 4 AS INT)) "
        "ELSE settlement_date END AS settlement_date",
        "CASE WHEN m IN (0, 1, 2) THEN quantity + 100 WHEN m = 6 THEN CAST(0 AS BIGINT) "
        "ELSE quantity END AS quantity",
        "CASE WHEN m IN (3, 4) THEN price + CAST(0.05 AS DOUBLE) "
        "WHEN m = 5 THEN price + CAST(0.01 AS DOUBLE) ELSE price END AS price",
        "CASE WHEN m IN (7, 8) THEN concat('NATION_', CAST(k % 25 AS STRING)) "
        "ELSE counterparty END AS counterparty",
        "CASE WHEN m IN (0, 1, 2, 7, 8) THEN 'Unmatched' WHEN m IN (3, 4, 5) THEN 'Partial Match' "
        f"WHEN m = 6 OR m BETWEEN 11 AND 20 THEN '{FAILED_STATUS}' "
        "WHEN m IN (9, 10) THEN 'Pending' ELSE 'Matched' END AS settlement_status",
    ).selectExpr(
        "trade_id", "trade_date", "settlement_date", "ticker", "trade_type", "quantity",
        "price", "counterparty", "currency", NOTIONAL, "'custodian' AS source",
        f"concat('CUS-', {_zpad('k', 8)}) AS custodian_ref", "settlement_status",
    )

    exchange = base.where("m <> 42").selectExpr(
        "k", "trade_id", "trade_date", "ticker", "trade_type", "price", "currency",
        "CASE WHEN m IN (0, 21) THEN quantity + 100 ELSE quantity END AS quantity",
    ).selectExpr(
        "trade_id", "trade_date", "ticker", "trade_type", "quantity", "price", "currency",
        NOTIONAL, "'exchange' AS source",
        f"concat('EXC-', {_zpad('k', 8)}) AS exchange_ref",
        f"concat('EXCH-', CAST(k % 3 AS STRING)) AS exchange",
        f"concat('VENUE-', CAST(k % 4 AS STRING)) AS execution_venue",
    )
    return Feeds(internal, custodian, exchange)


def duplicate_feeds(spark: SparkSession, sf_dir: str) -> Feeds:
    """Feeds with naturally duplicated keys: the trades of an order's lines
    all carry the order's key.  Some lines are missing or differ in a feed."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "CAST(l_orderkey AS STRING) AS trade_id", "l_orderkey AS k", "l_linenumber AS n",
        "CAST(l_quantity AS BIGINT) AS quantity", "CAST(l_extendedprice AS DOUBLE) AS price")

    def feed(rows: DataFrame, name: str) -> DataFrame:
        have = {"trade_id", "quantity", "price"}
        return rows.selectExpr(*[f.name if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
                                 for f in FEED_SCHEMAS[name].fields])

    custodian = lines.where("NOT (k % 3 = 0 AND n = 2)").withColumn(
        "quantity", F.expr("CASE WHEN k % 5 = 0 AND n = 1 THEN quantity + 100 ELSE quantity END"))
    exchange = lines.where("NOT (k % 4 = 0 AND n = 3)").withColumn(
        "quantity", F.expr("CASE WHEN k % 7 = 0 AND n = 4 THEN quantity + 200 ELSE quantity END"))
    return Feeds(feed(lines, "internal"), feed(custodian, "custodian"), feed(exchange, "exchange"))
