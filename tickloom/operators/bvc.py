"""Bulk volume classification: each trade's volume split by its price change against recent price changes.

The window of recent changes holds those not older than W. Sums over it are differences of running sums, so
the cost doesn't grow with W: each trade also stands, W earlier and before its equals, as a probe that picks up the running
sums before the window. Sums are whole numbers (nano-dollars, squares in decimals), so differences are
exact, and a window of equal changes has a deviation of exactly zero.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.market import normal_cdf
from tickloom.operators.quotes import by_seq, up_to_now
from tickloom.schema import DAY, EPS

MINUTE_NS = 60_000_000_000
#: Volumes are added up as whole shares and whole parts of one, so that no sum depends on its order.
GRAIN = 1 << 40


def shares(volume: Column) -> Column:
    return F.floor(volume)


def grains(volume: Column) -> Column:
    """What is left beside the whole shares of a volume."""
    return F.floor((volume - F.floor(volume)) * F.lit(float(GRAIN)) + F.lit(0.5))


def volume_of(whole: Column, parts: Column) -> Column:
    return whole.cast("double") + parts / F.lit(float(GRAIN))


def with_bvc(trades: DataFrame, window_minutes: int = 1) -> DataFrame:
    """trades (accepted ones of a day, times in order) with delta, sigma, window_n, bvc_buy and bvc_sell.

    Needs ts_recv_ns that doesn't fall with seq; replayed_bvc() takes days where it does.
    """
    delta = F.coalesce(F.col("price_nano") - F.lag("price_nano").over(by_seq()), F.lit(0)).cast("long")
    exact = F.col("delta").cast("decimal(19,0)")
    running = F.struct(F.count("*").over(up_to_now()).alias("n"), F.sum("delta").over(up_to_now()).alias("s"), F.sum((exact * exact).cast("decimal(38,0)")).over(up_to_now()).alias("q"))
    summed = trades.withColumn("delta", delta).withColumn("now", running)
    # Explode keeps the partitioning by day, which a union would not.
    both = summed.withColumn("probe", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("at", F.col("ts_recv_ns") - F.col("probe") * (window_minutes * MINUTE_NS))
    order = Window.partitionBy(*DAY).orderBy("at", F.col("probe").desc(), "seq").rowsBetween(Window.unboundedPreceding, -1)
    probed = both.withColumn("past", F.last(F.when(F.col("probe") == 0, F.col("now")), ignorenulls=True).over(order)).where("probe = 1")
    n = F.col("now.n") - F.coalesce("past.n", F.lit(0))
    s = (F.col("now.s") - F.coalesce("past.s", F.lit(0))).cast("decimal(19,0)")
    q = F.col("now.q") - F.coalesce("past.q", F.lit(0).cast("decimal(38,0)"))
    spread = ((q * n.cast("decimal(10,0)")).cast("decimal(38,0)") - (s * s).cast("decimal(38,0)")).cast("double")
    # Prices that move by thousands of dollars again and again outgrow 38 digits; floating point is near enough for those.
    rough = q.cast("double") * n - s.cast("double") * s.cast("double")
    spread = F.when((q.cast("double") * n < 1e37) & (s.cast("double") * s.cast("double") < 1e37), spread).otherwise(rough)
    sigma = F.when(n < 2, 0.0).otherwise(F.sqrt(F.greatest(spread, F.lit(0.0)) / F.greatest((n * (n - 1)).cast("double"), F.lit(1.0))) * F.lit(1e-9))
    out = probed.withColumns({"window_n": n, "sigma": sigma, "delta": F.col("delta").cast("double") * F.lit(1e-9)})
    z = F.when(F.col("sigma") > EPS, F.col("delta") / F.greatest("sigma", F.lit(EPS))).otherwise(0.0)
    out = out.withColumn("buy_share", normal_cdf(z))
    return out.withColumns({"bvc_buy": F.col("size") * F.col("buy_share"), "bvc_sell": F.col("size") * (F.lit(1.0) - F.col("buy_share"))}).drop("now", "past", "probe", "at", "buy_share")


def replayed_bvc(trades: DataFrame, window_minutes: int = 1) -> DataFrame:
    """The same, trade by trade, for days whose times fall: then only the oldest entry is ever evicted, which no frame expresses."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in trades.schema.fields) + ", delta double, window_n long, sigma double, bvc_buy double, bvc_sell double"
    width = window_minutes * MINUTE_NS

    def one_day(day: pd.DataFrame) -> pd.DataFrame:
        day = day.sort_values("seq")
        held: deque[tuple[int, int]] = deque()
        n = total = squares = 0
        last, rows = None, []
        for ts, price, size in zip(day["ts_recv_ns"].tolist(), day["price_nano"].tolist(), day["size"].tolist(), strict=True):
            d = price - last if last is not None else 0
            last = price
            held.append((ts, d))
            n, total, squares = n + 1, total + d, squares + d * d
            while held and max(0, ts - held[0][0]) > width:
                _, x = held.popleft()
                n, total, squares = n - 1, total - x, squares - x * x
            sigma = (max(0, squares * n - total * total) / (n * (n - 1))) ** 0.5 * 1e-9 if n > 1 else 0.0
            rows.append((d * 1e-9, n, sigma, size))
        delta, count, sigma, size = (np.array(c) for c in zip(*rows, strict=True))
        z = np.where(sigma > EPS, delta / np.maximum(sigma, EPS), 0.0)
        share = _phi(z)
        return day.assign(delta=delta, window_n=count.astype(np.int64), sigma=sigma, bvc_buy=size * share, bvc_sell=size * (1 - share))

    return trades.groupBy(*DAY).applyInPandas(one_day, schema)


def _phi(z: np.ndarray) -> np.ndarray:
    from tickloom.functions.market import _A, _P

    x = np.abs(z) / np.sqrt(2.0)
    t = 1.0 / (1.0 + _P * x)
    poly = np.full_like(t, _A[4])
    for a in reversed(_A[:4]):
        poly = poly * t + a
    erf = 1.0 - poly * t * np.exp(-x * x)
    return 0.5 * (1.0 + np.where(z < 0, -erf, erf))


def by_bin(trades: DataFrame) -> DataFrame:
    buy = F.col("bvc_buy")
    sums = trades.groupBy(*DAY, "bin_idx").agg(F.sum("size").alias("all"), F.sum(shares(buy)).alias("whole"), F.sum(grains(buy)).alias("parts"))
    return sums.select(*DAY, "bin_idx", volume_of(F.col("whole"), F.col("parts")).alias("bvc_buy"), volume_of(F.col("all") - F.col("whole"), -F.col("parts")).alias("bvc_sell"))
