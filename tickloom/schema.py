"""Columns, venues and constants of the event data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values.
NANO = 1e-9
EPS = 1e-8
UNDEFINED_PRICE = 2**63 - 1
SECOND_NS = 1_000_000_000
DAY_NS = 86_400 * SECOND_NS
LIT, TRF, MINOR_LIT, QUOTE_ONLY = (81,), (82, 83), (88, 89), (93,)
DEFAULT_HORIZONS = (1, 2, 3, 5, 10, 20, 30, 60)
SCHEMA_VERSION = 1.0
CONTRACT_VERSION = "off_exchange_1.0"
DIAGNOSTICS_VERSION = "1.2.0"

# The feature vector, in order.
FEATURES = (
    "trf_signed_imbalance",
    "mroib",
    "inv_inst_direction",
    "bvc_imbalance",
    "dark_share",
    "trf_volume",
    "lit_volume",
    "total_volume",
    "subpenny_intensity",
    "odd_lot_ratio",
    "retail_trade_rate",
    "retail_volume_fraction",
    "spread_bps",
    "bid_pressure",
    "ask_pressure",
    "bbo_update_rate",
    "quote_imbalance",
    "spread_change_rate",
    "trf_vpin",
    "lit_vpin",
    "mean_trade_size",
    "block_trade_ratio",
    "trade_count",
    "size_concentration",
    "trf_burst_intensity",
    "time_since_burst",
    "trf_lit_volume_ratio",
    "bin_trade_count",
    "bin_trf_trade_count",
    "bin_valid",
    "bbo_valid",
    "session_progress",
    "time_bucket",
    "schema_version",
)
#: Never normalised.
CATEGORICAL = frozenset({"bin_valid", "bbo_valid", "time_bucket", "schema_version"})
#: Carried over bins without off-exchange trades: always, unless quotes moved, and only with VPIN on.
STATE_FEATURES = ("dark_share", "subpenny_intensity", "odd_lot_ratio", "retail_volume_fraction", "mean_trade_size", "block_trade_ratio", "size_concentration", "trf_lit_volume_ratio")
QUOTE_STATE_FEATURES = ("spread_bps", "quote_imbalance")
VPIN_FEATURES = ("trf_vpin", "lit_vpin")
GROUPS = {
    "signed_flow": FEATURES[0:4],
    "venue_metrics": FEATURES[4:8],
    "retail_metrics": FEATURES[8:12],
    "bbo_dynamics": FEATURES[12:18],
    "vpin": FEATURES[18:20],
    "trade_size": FEATURES[20:24],
    "cross_venue": FEATURES[24:27],
}

#: Every ordered operator works within a day of a symbol; nothing crosses it.
DAY = ["symbol", "trade_date"]

EVENTS = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("seq", T.LongType()),
        T.StructField("ts_event_ns", T.LongType()),
        T.StructField("ts_recv_ns", T.LongType()),
        T.StructField("action", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("flags", T.IntegerType()),
        T.StructField("price_nano", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("bid_px_nano", T.LongType()),
        T.StructField("bid_sz", T.LongType()),
        T.StructField("ask_px_nano", T.LongType()),
        T.StructField("ask_sz", T.LongType()),
        T.StructField("publisher_id", T.IntegerType()),
    ]
)
CONTEXT = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("trade_date", T.DateType()),
        T.StructField("consolidated_volume", T.LongType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
    ]
)
