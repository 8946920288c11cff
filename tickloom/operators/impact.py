"""Signs from price changes alone, and the price impact of signed volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.quotes import by_seq, up_to_now
from tickloom.schema import DAY, NANO


def with_tick_test(trades: DataFrame) -> DataFrame:
    """trades (priced ones) with tick_sign: 1 or -1 by the last price change that wasn't zero, 0 before the day's first one."""
    change = F.col("price_nano") - F.lag("price_nano").over(by_seq())
    moved = trades.withColumn("_moved", F.when(change != 0, F.signum(change.cast("double")).cast("int")))
    return moved.withColumn("tick_sign", F.coalesce(F.last("_moved", ignorenulls=True).over(up_to_now()), F.lit(0))).drop("_moved")


def with_kyle_lambda(trades: DataFrame, signed: Column, window: int) -> DataFrame:
    """trades with kyle_lambda, the slope of price changes on signed volume over the last `window` of them, in USD a share; null with fewer, or where volume doesn't vary.

    Moments are differences of running sums of whole numbers, so they cost the same for any window and are exact.
    """
    wide = "decimal(38,0)"
    change = F.coalesce(F.col("price_nano") - F.lag("price_nano").over(by_seq()), F.lit(0))
    rows = trades.withColumns({"_x": change.cast("long"), "_v": signed.cast("long")})
    products = {"x": F.col("_x"), "v": F.col("_v"), "xv": F.col("_x") * F.col("_v"), "vv": F.col("_v") * F.col("_v")}
    summed = rows.withColumn("_now", F.struct(F.count("*").over(up_to_now()).alias("n"), *[F.sum(p.cast("decimal(28,0)")).over(up_to_now()).cast(wide).alias(n) for n, p in products.items()]))
    past = summed.withColumn("_past", F.lag("_now", window).over(by_seq()))
    diff = {n: (F.col(f"_now.{n}") - F.coalesce(F.col(f"_past.{n}"), F.lit(0).cast(wide))).cast("decimal(18,0)" if n in ("x", "v") else "decimal(32,0)") for n in products}
    count = F.lit(window).cast("decimal(6,0)")
    num = ((count * diff["xv"]).cast(wide) - (diff["x"] * diff["v"]).cast(wide)).cast("double")
    den = ((count * diff["vv"]).cast(wide) - (diff["v"] * diff["v"]).cast(wide)).cast("double")
    slope = F.when((F.col("_now.n") >= window) & (den > 0), num / F.when(den > 0, den) * F.lit(NANO))
    return past.withColumn("kyle_lambda", slope).drop("_x", "_v", "_now", "_past")


def lambda_by_bin(trades: DataFrame) -> DataFrame:
    """(DAY, bin_idx, kyle_lambda): the value after the bin's last trade."""
    return trades.groupBy(*DAY, "bin_idx").agg(F.max_by("kyle_lambda", "seq").alias("kyle_lambda"))
