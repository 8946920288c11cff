"""Structured Streaming: tumbling and sliding bins over an event stream, anchored at the market's open, with a watermark.

A bin is emitted when the watermark passes its end, so rows later than the watermark are left out; the batch plan
puts a late row into the bin open when it came. Times are microseconds here, as event time has to be a
timestamp; nanoseconds stay in the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.config import Config, seconds_of
from tickloom.functions.market import is_lit, is_trf, market_time_ns
from tickloom.schema import DAY, EPS


def _flow(events: DataFrame, cfg: Config, length: int, slide: int, lateness: str) -> DataFrame:
    """Flow of the session's trades by event-time windows of length seconds, one every slide seconds from the open on: partial aggregates combine before the one exchange by (symbol, window)."""
    ts = F.col("ts_recv_ns")
    opens, closes = market_time_ns(F.col("trade_date"), cfg.sampling.market_open_et), market_time_ns(F.col("trade_date"), cfg.sampling.market_close_et)
    traded = events.where((F.col("action") == "T") & (ts >= opens) & (ts < closes) & (F.col("price_nano") > 0) & (F.col("price_nano") != 2**63 - 1))
    # Windows start at the open. New York is whole hours from UTC, which every allowed bin size divides, so the open's minutes are enough.
    offset = seconds_of(cfg.sampling.market_open_et) % slide
    at = F.timestamp_micros(F.expr("ts_recv_ns div 1000"))
    binned = traded.withColumn("at", at).withWatermark("at", lateness).withColumn("trf", is_trf(F.col("publisher_id"))).withColumn("lit", is_lit(F.col("publisher_id")))
    volume = lambda c: F.sum(F.when(F.col(c), F.col("size")).otherwise(0)).cast("double")
    window = F.window("at", f"{length} seconds", f"{slide} seconds", f"{offset} seconds").alias("w")
    sums = binned.groupBy(*DAY, window).agg(F.count("*").alias("trades"), F.count_if("trf").alias("trf_trades"), volume("trf").alias("trf_volume"), volume("lit").alias("lit_volume"))
    total = F.col("trf_volume") + F.col("lit_volume")
    return sums.withColumn("dark_share", F.col("trf_volume") / F.greatest(total, F.lit(EPS)))


def stream_bins(events: DataFrame, cfg: Config, lateness: str = "10 seconds") -> DataFrame:
    """Flow of each bin from streaming canonical events."""
    size = cfg.sampling.bin_size_seconds
    opens = market_time_ns(F.col("trade_date"), cfg.sampling.market_open_et)
    idx = F.floor((F.unix_micros("w.start") * 1000 - opens) / F.lit(cfg.bin_ns))
    return _flow(events, cfg, size, size, lateness).select(*DAY, idx.alias("bin_idx"), "trades", "trf_trades", "trf_volume", "lit_volume", "dark_share")


def sliding_flow(events: DataFrame, cfg: Config, bins: int, lateness: str = "10 seconds") -> DataFrame:
    """Flow of the last `bins` bins, once a bin: windows that overlap. Those that begin before the open hold what is after it."""
    size = cfg.sampling.bin_size_seconds
    return _flow(events, cfg, bins * size, size, lateness).select(*DAY, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "trades", "trf_trades", "trf_volume", "lit_volume", "dark_share")


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Everything that is available, exactly once, to Parquet."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def snapshot(stream: DataFrame, path: str, checkpoint: str) -> None:
    """All bins so far, open ones too: each batch replaces the table at path."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    stream.writeStream.outputMode("complete").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's events as a stream of canonical events."""
    from tickloom.sources.adapter import from_driver_events

    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return from_driver_events(spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet"))  # a stream's source is a pattern or a folder
