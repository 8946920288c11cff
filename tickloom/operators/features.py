"""The 34 features of a bin, and the three-level policy for bins without off-exchange trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.functions.market import ratio, session_progress, time_bucket
from tickloom.schema import DAY, EPS, FEATURES, GROUPS, QUOTE_STATE_FEATURES, SCHEMA_VERSION, STATE_FEATURES, VPIN_FEATURES


def _num(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def with_state(grid: DataFrame) -> DataFrame:
    """Fills over the grid what outlives a bin: the quote state at its end, the last burst, the VPIN values."""
    so_far = Window.partitionBy(*DAY).orderBy("bin_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = {c: F.last(c, ignorenulls=True).over(so_far) for c in ("state", "burst_ts", "trf_vpin_now", "lit_vpin_now") if c in grid.columns}
    out = grid.withColumns(carried)
    return out.withColumn("mid_price", F.coalesce("state.mid", F.lit(0.0)))


def live_features(grid: DataFrame, cfg: Config) -> DataFrame:
    """The features as each bin itself gives them, before any filling. grid: processed bins with aggregates and with_state()."""
    v, one = cfg.validation, F.lit(1.0)
    trf_n, n = F.greatest(_num("trf_trades"), one), F.greatest(_num("trades"), one)
    buy, sell = _num("trf_buy_vol"), _num("trf_sell_vol")
    rbuy, rsell = _num("retail_buy_vol"), _num("retail_sell_vol")
    trf, lit = _num("trf_vol"), _num("lit_vol")
    valid = F.coalesce(F.col("state.bbo_valid"), F.lit(False))
    first = F.col("first_quote")
    quoted = F.coalesce(F.col("updates"), F.lit(0)) > 0
    tail = F.when(quoted, F.greatest(F.col("bin_end_ns") - F.col("last_quote.ts"), F.lit(0)).cast("double")).otherwise(0.0)
    held = _num("held_ns") + tail
    twap = F.when(held < EPS, 0.0).otherwise((_num("held_spread") + F.when(quoted, F.col("last_quote.spread") * tail).otherwise(0.0)) / F.greatest(held, F.lit(EPS)))
    spread_now = F.when(valid, F.col("state.spread_bps")).otherwise(0.0)
    bsz, asz = F.coalesce(F.col("state.bid_size").cast("double"), F.lit(0.0)), F.coalesce(F.col("state.ask_size").cast("double"), F.lit(0.0))
    pressure = lambda end, start: F.when(quoted & (start != 0), (end - start) / F.when(start != 0, start).cast("double")).otherwise(0.0)
    gaps = F.greatest(_num("gaps"), one)
    mean_gap = _num("gap_sum") / gaps
    gap_dev = F.sqrt(F.greatest(_num("gap_squares") / gaps - mean_gap * mean_gap, F.lit(0.0)))
    squares = _num("size_sum") * _num("size_sum")
    mroib = ratio(rbuy - rsell, rbuy + rsell)
    stale = F.greatest(F.lit(0), F.col("bin_end_ns") - F.col("state.ts"))
    values = {
        "trf_signed_imbalance": ratio(buy - sell, buy + sell),
        "mroib": mroib,
        "inv_inst_direction": -mroib + F.lit(0.0),
        "bvc_imbalance": ratio(_num("bvc_buy") - _num("bvc_sell"), _num("bvc_buy") + _num("bvc_sell")),
        "dark_share": ratio(trf, trf + lit),
        "trf_volume": trf,
        "lit_volume": lit,
        "total_volume": trf + lit,
        "subpenny_intensity": _num("subpenny_trades") / trf_n,
        "odd_lot_ratio": _num("odd_lots") / trf_n,
        "retail_trade_rate": _num("retail_trades") / trf_n,
        "retail_volume_fraction": ratio(_num("retail_vol"), trf),
        "spread_bps": F.when(twap > EPS, twap).otherwise(spread_now),
        "bid_pressure": pressure(bsz, first.bid_size),
        "ask_pressure": pressure(asz, first.ask_size),
        "bbo_update_rate": _num("updates"),
        "quote_imbalance": ratio(bsz - asz, bsz + asz),
        "spread_change_rate": F.when(quoted, spread_now - first.spread).otherwise(0.0),
        "trf_vpin": _num("trf_vpin_now") if cfg.features.vpin else F.lit(0.0),
        "lit_vpin": _num("lit_vpin_now") if cfg.features.vpin else F.lit(0.0),
        "mean_trade_size": _num("size_sum") / n,
        "block_trade_ratio": _num("block_trades") / n,
        "trade_count": _num("trades"),
        "size_concentration": F.when(squares < EPS, 0.0).otherwise(_num("size_squares") / F.greatest(squares, F.lit(EPS))),
        "trf_burst_intensity": F.when((_num("gaps") < 1) | (mean_gap < EPS), 0.0).otherwise(gap_dev / F.greatest(mean_gap, F.lit(EPS))),
        "time_since_burst": F.when(F.col("burst_ts").isNull(), float(v.warmup_bins * cfg.sampling.bin_size_seconds)).otherwise(F.greatest(F.lit(0), F.col("bin_end_ns") - F.col("burst_ts")) / F.lit(1e9)),
        "trf_lit_volume_ratio": ratio(trf, lit),
        "bin_trade_count": _num("trades"),
        "bin_trf_trade_count": _num("trf_trades"),
        "bin_valid": F.when(_num("trf_trades") >= v.min_trades_per_bin, 1.0).otherwise(0.0),
        "bbo_valid": F.when(valid & (stale <= v.bbo_staleness_max_ns), 1.0).otherwise(0.0),
        "session_progress": session_progress(F.col("bin_mid_ns"), F.col("open_ns"), cfg),
        "time_bucket": time_bucket(F.col("bin_mid_ns"), F.col("trade_date")),
        "schema_version": F.lit(SCHEMA_VERSION),
    }
    off = {f for group, names in GROUPS.items() if not getattr(cfg.features, group) for f in names}
    return grid.withColumns({name: F.lit(0.0) if name in off else values[name].cast("double") for name in FEATURES})


def filled_features(live: DataFrame, cfg: Config) -> DataFrame:
    """The features after the empty-bin policy.

    A bin without off-exchange trades takes its state features from the last earlier bin that has some; its
    quote features too, unless it has quote updates of its own, then also from bins that only have updates. The
    filled values equal their source's own values, so one backward look is enough.
    """
    before = Window.partitionBy(*DAY).orderBy("bin_idx").rowsBetween(Window.unboundedPreceding, -1)
    traded, moved = F.coalesce(F.col("trf_trades"), F.lit(0)) > 0, F.coalesce(F.col("updates"), F.lit(0)) > 0
    state = [*STATE_FEATURES, *(VPIN_FEATURES if cfg.features.vpin else ())]
    last_traded = F.last(F.when(traded, F.struct(*state)), ignorenulls=True).over(before)
    last_moved = F.last(F.when(traded | moved, F.struct(*QUOTE_STATE_FEATURES)), ignorenulls=True).over(before)
    out = live.withColumns({"_traded": last_traded, "_moved": last_moved})
    filled = {f: F.when(traded, F.col(f)).otherwise(F.coalesce(F.col(f"_traded.{f}"), F.lit(0.0))) for f in state}
    filled |= {f: F.when(traded | moved, F.col(f)).otherwise(F.coalesce(F.col(f"_moved.{f}"), F.lit(0.0))) for f in QUOTE_STATE_FEATURES}
    return out.withColumns(filled).drop("_traded", "_moved")


def asserted(bins: DataFrame) -> DataFrame:
    """bins, failing the job at the first one with a feature that isn't finite, a gate that isn't 0 or 1, or a progress outside [0, 1]. A debugging aid: it costs a look at every feature."""
    finite = F.lit(True)
    for f in FEATURES:
        finite = finite & F.col(f).isNotNull() & ~F.isnan(F.col(f)) & (F.abs(F.col(f)) < float("inf"))
    gates = F.col("bin_valid").isin(0.0, 1.0) & F.col("bbo_valid").isin(0.0, 1.0) & F.col("session_progress").between(0.0, 1.0)
    broken = F.when(~F.coalesce(finite & gates, F.lit(False)), F.raise_error(F.concat(F.lit("a feature is out of bounds in bin "), F.col("bin_idx").cast("string"))))
    return bins.withColumn("bin_idx", F.coalesce(broken.cast("long"), F.col("bin_idx")))
