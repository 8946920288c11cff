"""Quote state: which updates are accepted, and the best bid and offer carried as of every record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.market import microprice, midpoint, quote_check, spread_bps, usd
from tickloom.schema import DAY


def by_seq():
    """The one order of a day's records. Every ordered operator uses this same window, so they share one exchange and one sort."""
    return Window.partitionBy(*DAY).orderBy("seq")


def up_to_now():
    return by_seq().rowsBetween(Window.unboundedPreceding, Window.currentRow)


def up_to_previous():
    return by_seq().rowsBetween(Window.unboundedPreceding, -1)


def with_bbo(events: DataFrame, **more: Column) -> DataFrame:
    """Adds quote_check and, as of each record and its own quote, the last accepted quote: bbo_valid, bid, ask, bid_size, ask_size, mid, spread, bbo_spread_bps, microprice, bbo_ts.

    A rejected update keeps the state before it. Every record's quote counts, whatever its action. more: further columns over the same order, taken in the same pass.
    """
    check = quote_check(F.col("bid_px_nano"), F.col("ask_px_nano"))
    own = F.struct(usd(F.col("bid_px_nano")).alias("bid"), usd(F.col("ask_px_nano")).alias("ask"), F.col("bid_sz").alias("bid_size"), F.col("ask_sz").alias("ask_size"), F.col("ts_recv_ns").alias("ts"))
    state = F.last(F.when(F.col("quote_check") == "ok", own), ignorenulls=True).over(up_to_now())
    out = events.withColumn("quote_check", check).withColumns({"bbo": state} | more)
    bid, ask = F.col("bbo.bid"), F.col("bbo.ask")
    return out.select(
        *events.columns,
        *more,
        "quote_check",
        F.col("bbo").isNotNull().alias("bbo_valid"),
        bid.alias("bid"),
        ask.alias("ask"),
        F.col("bbo.bid_size").alias("bid_size"),
        F.col("bbo.ask_size").alias("ask_size"),
        midpoint(bid, ask).alias("mid"),
        (ask - bid).alias("spread"),
        spread_bps(bid, ask).alias("bbo_spread_bps"),
        microprice(bid, F.col("bbo.bid_size"), ask, F.col("bbo.ask_size")).alias("microprice"),
        F.col("bbo.ts").alias("bbo_ts"),
    )


def as_of_quotes(trades: DataFrame, quotes: DataFrame) -> DataFrame:
    """trades with the latest accepted quote at or before them, where quotes are a table of their own.

    A union in one order, not a range join: a quote at the trade's own time counts. trades: DAY, seq, ts_recv_ns; quotes: those and the quote columns.
    """
    sides = ["bid_px_nano", "bid_sz", "ask_px_nano", "ask_sz"]
    payload = F.struct(*[F.col(c) for c in trades.columns])
    left = trades.select(*DAY, "seq", "ts_recv_ns", F.lit(1).alias("kind"), payload.alias("trade"), *[F.lit(None).cast("long").alias(c) for c in sides])
    right = quotes.select(*DAY, "seq", "ts_recv_ns", F.lit(0).alias("kind"), F.lit(None).cast(left.schema["trade"].dataType).alias("trade"), *sides)
    own = F.when((F.col("kind") == 0) & (quote_check(F.col("bid_px_nano"), F.col("ask_px_nano")) == "ok"), F.struct(usd(F.col("bid_px_nano")).alias("bid"), usd(F.col("ask_px_nano")).alias("ask"), F.col("bid_sz").alias("bid_size"), F.col("ask_sz").alias("ask_size"), F.col("ts_recv_ns").alias("ts")))
    order = Window.partitionBy(*DAY).orderBy("ts_recv_ns", "kind", "seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    merged = left.unionByName(right).withColumn("quote", F.last(own, ignorenulls=True).over(order)).where("kind = 1")
    return merged.select("trade.*", F.col("quote.bid").alias("quote_bid"), F.col("quote.ask").alias("quote_ask"), F.col("quote.bid_size").alias("quote_bid_size"), F.col("quote.ask_size").alias("quote_ask_size"), F.col("quote.ts").alias("quote_ts"))


def quote_counters(checked: DataFrame) -> DataFrame:
    """Per day: accepted, crossed and invalid quotes, over all records."""
    n = lambda k: F.count_if(F.col("quote_check") == k)
    return checked.groupBy(*DAY).agg(n("ok").alias("updates"), n("crossed").alias("crossed"), n("invalid").alias("invalid"))
