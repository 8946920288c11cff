"""Bursts: k off-exchange trades of one bin within a second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.quotes import by_seq
from tickloom.schema import DAY


def bursts(trades: DataFrame, threshold: int, window_ns: int) -> DataFrame:
    """(DAY, bin_idx, burst_ts): the last trade in the bin that completes a burst. trades: accepted off-exchange ones.

    A trade completes a burst if the one threshold-1 before it is of the same bin and within the window. Bins don't
    fall with seq, so the day's order serves, and the exchange and sort for it.
    """
    back = threshold - 1
    was = F.lag(F.struct("bin_idx", "ts_recv_ns"), back).over(by_seq())
    done = trades.withColumn("was", was).where((F.col("was.bin_idx") == F.col("bin_idx")) & (F.greatest(F.col("ts_recv_ns") - F.col("was.ts_recv_ns"), F.lit(0)) <= window_ns))
    return done.groupBy(*DAY, "bin_idx").agg(F.max_by("ts_recv_ns", "seq").alias("burst_ts"))
