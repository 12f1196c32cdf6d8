"""Streaming use of the row-level operators.

The reference is a batch pipeline: it has no watermark, window or state
operator.  What carries over to Structured Streaming unchanged is the
row-level part -- break flags, label, value and aging are stateless column
expressions -- so a stream of already-joined rows (for example the output
of an upstream matching service, landing as files) can be classified and
its breaks appended to a table continuously.  The join and the summaries
stay batch jobs over the accumulated table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..config import ReconConfig
from ..operators import aging, breaks


def joined_schema(spark: SparkSession):
    """Schema of the 26 joined columns (for a file stream source)."""
    from pyspark.sql import types as T
    S, D, L, F = T.StringType(), T.DateType(), T.LongType(), T.DoubleType()
    types = {
        "trade_id": S, "trade_date": D, "settlement_date_int": D, "ticker": S, "trade_type": S,
        "quantity_int": L, "price_int": F, "counterparty_int": S, "currency": S,
        "notional_value_int": F, "source": S, "trader_id": S, "desk": S, "booking_time": S,
        "quantity_cust": L, "price_cust": F, "counterparty_cust": S, "settlement_date_cust": D,
        "settlement_status": S, "custodian_ref": S, "notional_value_cust": F,
        "quantity_exch": L, "price_exch": F, "exchange_ref": S, "exchange": S,
        "execution_venue": S,
    }
    return T.StructType([T.StructField(c, types[c], True) for c in schemas.JOINED_COLUMNS])


def classify_stream(joined: DataFrame, cfg: ReconConfig | None = None) -> DataFrame:
    """Report columns for a (streaming or batch) frame of joined rows."""
    cfg = cfg or ReconConfig()
    out = aging.add_aging(breaks.classify(joined, cfg), cfg.as_of)
    return out.select(*schemas.REPORT_COLUMNS)


def stream_breaks_to_parquet(joined: DataFrame, path: str, checkpoint: str,
                             cfg: ReconConfig | None = None,
                             trigger_once: bool = False) -> StreamingQuery:
    """Append the breaks of a joined-row stream to a parquet table.

    ``checkpoint`` must be on shared storage (e.g. under the cluster's
    spark.checkpoint.dir) so a restarted query resumes exactly once."""
    breaks_only = classify_stream(joined, cfg).where("is_break")
    w = (breaks_only.writeStream.format("parquet").outputMode("append")
         .option("path", path).option("checkpointLocation", checkpoint))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
