"""The driver's `events` table as an event stream: a fixed, integer-only mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schema import EVENTS, UNDEFINED_PRICE


def from_driver_events(events: DataFrame) -> DataFrame:
    """Canonical events of one symbol; each day is squeezed into 08:00 to 18:00 New York winter time."""
    e = F.col("event_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("long")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    day = F.floor(us / F.lit(86_400_000_000)).cast("long")
    # Long arithmetic: the quotient of two longs would be a double, so floors go through div.
    squeezed = F.expr("((us - day * 86400000000L) * 5L) div 12L")
    base = events.select(e.alias("seq"), "event_type", k.alias("k"), us.alias("us"), day.alias("day"), F.floor(F.col("value") * 100).cast("long").alias("cents"))
    steps = base.withColumn("base_bid", F.lit(100_000_000_000) + (F.expr("(seq * 7919L) % 201L") - 100) * 10_000_000)
    steps = steps.withColumn("base_ask", F.col("base_bid") + (1 + F.expr("k % 5")) * 10_000_000)
    stamp = (F.col("day") * F.lit(86_400_000_000) + F.lit(46_800_000_000) + squeezed) * 1000
    kind = F.col("event_type")
    out = steps.select(
        F.lit("SYN").alias("symbol"),
        F.date_from_unix_date(F.col("day").cast("int")).alias("trade_date"),
        "seq",
        (stamp - 100_000).alias("ts_event_ns"),
        stamp.alias("ts_recv_ns"),
        F.when(kind == "view", "A").otherwise("T").alias("action"),
        F.lit("N").alias("side"),
        F.lit(0).alias("flags"),
        F.when(F.col("k") == 97, F.lit(0).cast("long")).otherwise(F.col("base_bid") + F.expr("((base_ask - base_bid) * ((seq * 104729L) % 1001L)) div 1000L")).alias("price_nano"),
        F.when(F.col("k") == 99, F.lit(12_000).cast("long")).otherwise(1 + F.expr("cents % 500")).alias("size"),
        F.when(F.expr("k % 41 = 0"), F.lit(UNDEFINED_PRICE)).otherwise(F.col("base_bid")).alias("bid_px_nano"),
        (1 + F.expr("(seq * 31L) % 900L")).alias("bid_sz"),
        F.when(F.expr("k % 37 = 0"), F.col("base_bid")).otherwise(F.col("base_ask")).alias("ask_px_nano"),
        (1 + F.expr("(seq * 17L) % 900L")).alias("ask_sz"),
        F.when(F.col("k") == 98, 999).when(kind == "view", 93).when(kind == "click", 82).when(kind == "signup", 83).when(kind == "purchase", 81).otherwise(88).alias("publisher_id"),
    )
    return out.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS])


def driver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_driver_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
