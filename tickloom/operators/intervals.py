"""Joins of points with intervals, by buckets of time.

Every interval is cut over the buckets that it touches and every point is in one bucket, so the join has an equal key and the
inequality only looks at what shares it. A bucket is as wide as the intervals are on average, so cutting at most doubles them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.market import quote_check, usd
from tickloom.schema import DAY, DAY_NS


def mean_length(intervals: DataFrame, start: str, end: str) -> int:
    """A bucket's width: the intervals' mean length, at least 1."""
    found = intervals.where(F.col(end) > F.col(start)).agg(F.sum((F.col(end) - F.col(start)).cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).first()
    return max(1, -(-int(found.s) // found.n)) if found.n else 1


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, width: int | None = None, how: str = "left") -> DataFrame:
    """points with the columns of each interval of the same keys that holds them, its start included, its end not. how: left or inner.

    Intervals may overlap; a point then comes once for each. Empty intervals hold nothing. keys, at, start and end are not null.
    """
    width = width or mean_length(intervals, start, end)
    whole = intervals.where(F.col(end) > F.col(start))
    pieces = whole.withColumn("_bucket", F.explode(F.sequence(F.expr(f"`{start}` div {width}"), F.expr(f"(`{end}` - 1) div {width}"))))
    renamed = pieces.select(*[F.col(k).alias(f"_{k}") for k in keys], "_bucket", *[c for c in intervals.columns if c not in keys])
    placed = points.withColumn("_slot", F.expr(f"`{at}` div {width}"))
    same = F.col("_slot") == F.col("_bucket")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_{k}"))
    joined = placed.join(renamed, same & (F.col(start) <= F.col(at)) & (F.col(at) < F.col(end)), how)
    return joined.select(*points.columns, *[c for c in intervals.columns if c not in keys])


def validity(quotes: DataFrame) -> DataFrame:
    """Accepted quotes with the time in which each is the last one: DAY, quote_ts, quote_until, bid, ask and sizes. The day's last holds to its end."""
    ok = quotes.where(quote_check(F.col("bid_px_nano"), F.col("ask_px_nano")) == "ok")
    then = F.lead("ts_recv_ns").over(Window.partitionBy(*DAY).orderBy("ts_recv_ns", "seq"))
    over = (F.unix_date("trade_date").cast("long") + 2) * DAY_NS
    return ok.select(*DAY, F.col("ts_recv_ns").alias("quote_ts"), F.greatest(F.coalesce(then, over), F.col("ts_recv_ns")).alias("quote_until"), usd(F.col("bid_px_nano")).alias("quote_bid"), usd(F.col("ask_px_nano")).alias("quote_ask"), F.col("bid_sz").alias("quote_bid_size"), F.col("ask_sz").alias("quote_ask_size"))


def quotes_in_force(trades: DataFrame, quotes: DataFrame, width: int | None = None) -> DataFrame:
    """trades with the quote in force at their time: what as_of_quotes() gives, by way of intervals."""
    return interval_join(trades, validity(quotes), list(DAY), "ts_recv_ns", "quote_ts", "quote_until", width).drop("quote_until")
