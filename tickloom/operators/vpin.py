"""Volume-synchronised probability of informed trading, by venue class, in buckets of equal volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.bvc import grains, shares, volume_of, with_bvc
from tickloom.operators.quotes import up_to_now
from tickloom.schema import DAY


def vpin_buckets(trades: DataFrame, bucket_volume: Column | int, lookback: int, window_minutes: int = 1) -> DataFrame:
    """(DAY, bucket, buy, sell, bin_idx, imbalance, vpin) of the full buckets; trades are one venue class's accepted ones.

    A trade that straddles buckets is split in proportion. Sums are whole numbers, whatever their order. bin_idx is the bin of the trade that fills the bucket.
    """
    volume = F.lit(bucket_volume).cast("long") if isinstance(bucket_volume, int) else bucket_volume
    split = with_bvc(trades, window_minutes).where("size > 0").withColumn("through", F.sum("size").over(up_to_now())).withColumn("volume", volume)
    first, last = F.floor((F.col("through") - F.col("size")) / F.col("volume")), F.floor((F.col("through") - 1) / F.col("volume"))
    parts = split.withColumn("bucket", F.explode(F.sequence(first, last)))
    inside = F.least(F.col("through"), (F.col("bucket") + 1) * F.col("volume")) - F.greatest(F.col("through") - F.col("size"), F.col("bucket") * F.col("volume"))
    bought = F.col("bvc_buy") * (inside.cast("double") / F.col("size"))
    sums = parts.groupBy(*DAY, "bucket", "volume").agg(F.sum(shares(bought)).alias("whole"), F.sum(grains(bought)).alias("parts"), F.sum(inside).alias("filled"), F.max_by("bin_idx", "seq").alias("bin_idx"))
    full = sums.where("filled = volume").withColumns({"buy": volume_of(F.col("whole"), F.col("parts")), "sell": volume_of(F.col("filled") - F.col("whole"), -F.col("parts"))})
    gap = F.abs(volume_of(F.col("filled") - 2 * F.col("whole"), -2 * F.col("parts")))
    recent = Window.partitionBy(*DAY).orderBy("bucket").rowsBetween(-(lookback - 1), Window.currentRow)
    return full.withColumn("imbalance", gap / F.col("volume")).withColumn("vpin", F.avg("imbalance").over(recent)).select(*DAY, "bucket", "buy", "sell", "bin_idx", "imbalance", "vpin")


def by_bin(buckets: DataFrame, name: str) -> DataFrame:
    """(DAY, bin_idx, name): the value after the last bucket filled in the bin."""
    return buckets.groupBy(*DAY, "bin_idx").agg(F.max_by("vpin", "bucket").alias(name))
