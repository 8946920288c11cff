"""What a bin sums up: volumes by venue and side, counts, sizes, quotes at its start and end, the time-weighted spread."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.functions.market import is_subpenny
from tickloom.operators.quotes import up_to_previous
from tickloom.schema import DAY


def with_previous(records: DataFrame, cfg: Config) -> DataFrame:
    """Adds prev_quote (bin, time, spread of the last counted quote update), prev_trf (bin, time of the last accepted off-exchange trade) and burst, in the day's one order and one pass.

    burst: whether an accepted off-exchange trade is the last of burst_threshold ones of its bin within the window.
    """
    quote = F.when(F.col("quoted"), F.struct(F.col("bin_idx").alias("bin"), F.col("ts_recv_ns").alias("ts"), F.col("bbo_spread_bps").alias("spread")))
    mine = F.when(F.col("accepted") & F.col("trf"), F.struct(F.col("bin_idx").alias("bin"), F.col("ts_recv_ns").alias("ts")))
    ahead = records.withColumns({"_quote": quote, "_trade": mine})
    back = F.expr(f"lag(_trade, {cfg.validation.burst_threshold - 1}) ignore nulls over (partition by {', '.join(DAY)} order by seq)")
    out = ahead.withColumns({"prev_quote": F.last("_quote", ignorenulls=True).over(up_to_previous()), "prev_trf": F.last("_trade", ignorenulls=True).over(up_to_previous()), "_was": back})
    near = F.greatest(F.col("ts_recv_ns") - F.col("_was.ts"), F.lit(0)) <= cfg.validation.burst_window_ns
    burst = F.col("accepted") & F.col("trf") & (F.col("_was.bin") == F.col("bin_idx")) & near
    return out.withColumn("burst", F.coalesce(burst, F.lit(False))).drop("_quote", "_trade", "_was")


def bin_aggregates(records: DataFrame, cfg: Config) -> DataFrame:
    """One row per (DAY, bin_idx) that has records. The day's partitioning serves the aggregation: there is no further exchange."""
    acc, trf, lit = F.col("accepted"), F.col("accepted") & F.col("trf"), F.col("accepted") & F.col("lit")
    size, retail = F.col("size"), F.col("retail") == "Retail"
    volume = lambda when: F.coalesce(F.sum(F.when(when, size)), F.lit(0)).cast("double")
    n = F.count_if
    quoted = F.col("quoted")
    prev = F.col("prev_quote")
    held = F.when(quoted & (prev.bin == F.col("bin_idx")), F.greatest(F.col("ts_recv_ns") - prev.ts, F.lit(0)).cast("double"))
    gap = F.when(trf & (F.col("prev_trf.bin") == F.col("bin_idx")), F.greatest(F.col("ts_recv_ns") - F.col("prev_trf.ts"), F.lit(0)).cast("double"))
    # By field, not as structs: buffers of plain numbers keep the aggregation hashed, where structs would have every record sorted again.
    quote = {"bid_size": "bid_size", "ask_size": "ask_size", "spread": "bbo_spread_bps", "ts": "ts_recv_ns"}
    state = {"bid": "bid", "ask": "ask", "bid_size": "bid_size", "ask_size": "ask_size", "mid": "mid", "spread_bps": "bbo_spread_bps", "ts": "bbo_ts"}
    at_quote, at_state = F.when(quoted, F.col("seq")), F.when(F.col("bbo_valid"), F.col("seq"))
    picked = [
        *[F.min_by(c, at_quote).alias(f"_first_{k}") for k, c in quote.items()],
        *[F.max_by(c, at_quote).alias(f"_last_{k}") for k, c in quote.items()],
        *[F.max_by(c, at_state).alias(f"_state_{k}") for k, c in state.items()],
    ]
    whole = lambda name, fields, when, *more: F.when(when, F.struct(*more, *[F.col(f"_{name}_{k}").alias(k) for k in fields]))
    sums = records.groupBy(*DAY, "bin_idx").agg(
        *picked,
        F.min("open_ns").alias("open_ns"),
        F.min("close_ns").alias("close_ns"),
        volume(trf & (F.col("direction") == "Buy")).alias("trf_buy_vol"),
        volume(trf & (F.col("direction") == "Sell")).alias("trf_sell_vol"),
        volume(trf & (F.col("direction") == "Unsigned")).alias("trf_unsigned_vol"),
        volume(trf).alias("trf_vol"),
        volume(lit).alias("lit_vol"),
        volume(trf & retail).alias("retail_vol"),
        volume(trf & retail & (F.col("direction") == "Buy")).alias("retail_buy_vol"),
        volume(trf & retail & (F.col("direction") == "Sell")).alias("retail_sell_vol"),
        n(acc).alias("trades"),
        n(trf).alias("trf_trades"),
        n(lit).alias("lit_trades"),
        n(trf & retail).alias("retail_trades"),
        n(trf & is_subpenny(F.col("price"))).alias("subpenny_trades"),
        n(trf & (size < 100)).alias("odd_lots"),
        n(acc & (size >= cfg.validation.block_threshold)).alias("block_trades"),
        volume(acc).alias("size_sum"),
        F.coalesce(F.sum(F.when(acc, (size * size).cast("double"))), F.lit(0.0)).alias("size_squares"),
        n("dropped").alias("dropped"),
        n(quoted).alias("updates"),
        F.coalesce(F.sum(held), F.lit(0.0)).alias("held_ns"),
        F.coalesce(F.sum(held * prev.spread), F.lit(0.0)).alias("held_spread"),
        F.count(gap).alias("gaps"),
        F.coalesce(F.sum(gap), F.lit(0.0)).alias("gap_sum"),
        F.coalesce(F.sum(gap * gap), F.lit(0.0)).alias("gap_squares"),
        F.max_by("ts_recv_ns", F.when(F.col("burst"), F.col("seq"))).alias("burst_ts"),
    )
    sums = sums.withColumns({"first_quote": whole("first", quote, F.col("updates") > 0), "last_quote": whole("last", quote, F.col("updates") > 0), "state": whole("state", state, F.col("_state_ts").isNotNull(), F.lit(True).alias("bbo_valid"))})
    return sums.drop(*[c for c in sums.columns if c.startswith("_")])
