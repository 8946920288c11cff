"""From events to feature bins: the whole dataflow as one declarative plan.

For quotes, classes, bursts and bins, events are exchanged once, by day of a symbol, and sorted once, by seq; the ordered operators over
records share both. Trades' side branches (bulk volume, VPIN) exchange and sort trades again; they need only columns that are there before classification,
and bins are few, so everything after the per-bin aggregation is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.functions.market import is_trf
from tickloom.operators import aggregates, bins, bvc, features, quotes, trades, vpin
from tickloom.schema import DAY


def records(events: DataFrame, cfg: Config) -> DataFrame:
    """Every record with its quote state, class, bin and flags."""
    seen = quotes.with_bbo(events, _reached=bins.reached(cfg))
    return bins.with_flags(bins.with_bins(trades.with_classes(seen, cfg.classification), cfg, F.col("_reached")).drop("_reached"))


def accepted_trades(events: DataFrame, cfg: Config, times_in_order: bool = False) -> DataFrame:
    """The accepted trades with their bin, without what only classification needs. With times in order a trade's own time tells its bin, so that only accepted trades are exchanged."""
    narrow = events.select(*DAY, "seq", "ts_recv_ns", "action", "price_nano", "size", "publisher_id")
    binned = bins.with_bins(narrow, cfg, F.col("ts_recv_ns") if times_in_order else None)
    price = F.col("price_nano")
    return binned.where((F.col("action") == "T") & F.col("in_session") & (price > 0) & (price != 2**63 - 1)).select(*DAY, "seq", "ts_recv_ns", "price_nano", "size", "publisher_id", "bin_idx")


def processed_bins(events: DataFrame, cfg: Config, context: DataFrame | None = None, times_in_order: bool = True) -> DataFrame:
    """Every processed bin with its aggregates, its place in the grid and the state at its end; emit marks those past warm-up.

    times_in_order=False is for days whose receive times fall now and then: bulk volume is then replayed trade by trade.
    """
    sums = aggregates.bin_aggregates(aggregates.with_previous(records(events, cfg), cfg), cfg)
    grid = bins.emitted(bins.day_grid(sums, cfg), cfg)
    traded = accepted_trades(events, cfg, times_in_order)
    keys = [*DAY, "bin_idx"]
    bulk = bvc.with_bvc if times_in_order else bvc.replayed_bvc
    grid = grid.join(bvc.by_bin(bulk(traded, cfg.vpin.sigma_window_minutes)), keys, "left")
    if cfg.features.vpin:
        grid = grid.join(vpin_by_bin(traded, cfg, context, "Trf"), keys, "left").join(vpin_by_bin(traded, cfg, context, "Lit"), keys, "left")
    return features.with_state(grid)


def bucketed(traded: DataFrame, cfg: Config, context: DataFrame | None, which: str) -> DataFrame:
    """VPIN buckets of one venue class; with a fraction set, a day's bucket is that share of its consolidated volume."""
    from tickloom.functions.market import is_lit

    mine = traded.where((is_trf if which == "Trf" else is_lit)(F.col("publisher_id")))
    volume = cfg.vpin.bucket_volume
    if cfg.vpin.bucket_volume_fraction is not None and context is not None:
        mine = mine.join(context.select(*DAY, "consolidated_volume"), DAY, "left")
        own = F.floor(F.col("consolidated_volume") * F.lit(cfg.vpin.bucket_volume_fraction))
        volume = F.when(own > 0, own).otherwise(F.lit(cfg.vpin.bucket_volume)).cast("long")
    return vpin.vpin_buckets(mine, volume, cfg.vpin.lookback_buckets, cfg.vpin.sigma_window_minutes)


def vpin_by_bin(traded: DataFrame, cfg: Config, context: DataFrame | None, which: str) -> DataFrame:
    return vpin.by_bin(bucketed(traded, cfg, context, which), f"{which.lower()}_vpin_now")


def all_bins(events: DataFrame, cfg: Config, context: DataFrame | None = None, times_in_order: bool = True) -> DataFrame:
    """Processed bins with all 34 features, warm-up included (its values feed the filling)."""
    return features.filled_features(features.live_features(processed_bins(events, cfg, context, times_in_order), cfg), cfg)


def feature_bins(events: DataFrame, cfg: Config, context: DataFrame | None = None, times_in_order: bool = True) -> DataFrame:
    """The emitted bins: DAY, bin_idx, bin_end_ns, is_gap, is_final, mid_price and the 34 features."""
    from tickloom.schema import FEATURES

    out = all_bins(events, cfg, context, times_in_order).where("emit")
    return out.select(*DAY, "bin_idx", "bin_end_ns", "is_gap", F.col("is_flush").alias("is_final"), "mid_price", *FEATURES)
