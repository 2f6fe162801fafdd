"""Bars from a stream of ticks: an extension, with event-time windows and a watermark for late ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bars(ticks: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Finished bars of (ticker, ts, seq, price, size); ``ts`` is a timestamp. Append mode emits a bar once."""
    at = F.struct("ts", "seq")
    bars = ticks.withWatermark("ts", late).groupBy("ticker", F.window("ts", width).alias("w")).agg(
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"), F.sum("size").alias("volume"), F.count(F.lit(1)).alias("transactions")
    )
    return bars.select("ticker", F.col("w.start").alias("ts"), F.col("w.end").alias("end_ts"), "open", "high", "low", "close", "volume", "transactions")
