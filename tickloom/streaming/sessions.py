"""Bursts of activity: trades of a symbol's day with no more than a gap of inactivity between them.

The same expression serves tables and streams. In a stream a session stays open, and is merged with others over batches, until the
watermark has passed its end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.market import is_lit, is_trade, is_trf
from tickloom.schema import DAY, UNDEFINED_PRICE


def activity_sessions(events: DataFrame, gap: str = "5 minutes", lateness: str | None = None) -> DataFrame:
    """(DAY, start_us, end_us, trades, volume, trf_volume, lit_volume, low_nano, high_nano): end_us is the last trade's time plus the gap; a trade exactly there begins another session."""
    priced = F.coalesce((F.col("price_nano") > 0) & (F.col("price_nano") != UNDEFINED_PRICE), F.lit(False))
    traded = events.where(is_trade(F.col("action")) & priced).withColumn("at", F.timestamp_micros(F.expr("ts_recv_ns div 1000")))
    traded = traded if lateness is None else traded.withWatermark("at", lateness)
    size, publisher = F.col("size"), F.col("publisher_id")
    volume = lambda when: F.sum(F.when(when, size).otherwise(0))
    sums = traded.groupBy(*DAY, F.session_window("at", gap).alias("w")).agg(F.count("*").alias("trades"), F.sum("size").alias("volume"), volume(is_trf(publisher)).alias("trf_volume"), volume(is_lit(publisher)).alias("lit_volume"), F.min("price_nano").alias("low_nano"), F.max("price_nano").alias("high_nano"))
    return sums.select(*DAY, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "trades", "volume", "trf_volume", "lit_volume", "low_nano", "high_nano")
