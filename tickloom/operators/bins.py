"""The grid of time bins: which bin a record belongs to, which bins are emitted, and where a day stops.

A bin is closed by the first record of a later bin, so a late record joins the bin open at the time; and a
record at or after the close opens no bin. Both follow from a running maximum over the session's times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.functions.market import is_trade, market_time_ns
from tickloom.operators.quotes import up_to_now
from tickloom.schema import DAY


def session_of(cfg: Config) -> tuple[Column, Column]:
    """The open and the close of a record's day."""
    return tuple(market_time_ns(F.col("trade_date"), at) for at in (cfg.sampling.market_open_et, cfg.sampling.market_close_et))


def reached(cfg: Config) -> Column:
    """The latest time before the close up to each record, in the day's one order."""
    ts = F.col("ts_recv_ns")
    return F.max(F.when(ts < session_of(cfg)[1], ts)).over(up_to_now())


def with_bins(records: DataFrame, cfg: Config, upto: Column | None = None) -> DataFrame:
    """Adds open_ns, close_ns, in_session, bin_idx. upto: reached(), where it is there already, or the record's own time where times are in order."""
    opens, closes = session_of(cfg)
    ts = F.col("ts_recv_ns")
    out = records.withColumns({"open_ns": opens, "close_ns": closes})
    out = out.withColumn("in_session", (ts >= F.col("open_ns")) & (ts < F.col("close_ns")))
    upto = reached(cfg) if upto is None else upto
    return out.withColumn("bin_idx", F.greatest(F.lit(0).cast("long"), F.coalesce(F.floor((upto - F.col("open_ns")) / F.lit(cfg.bin_ns)), F.lit(0))))


def with_flags(records: DataFrame) -> DataFrame:
    """Adds accepted (a trade that counts), dropped (in session, without a price) and quoted (a quote update that counts)."""
    traded = is_trade(F.col("action")) & F.col("in_session")
    return records.withColumns({"accepted": traded & F.col("priced"), "dropped": traded & ~F.col("priced"), "quoted": F.col("in_session") & (F.col("quote_check") == "ok")})


def day_grid(activity: DataFrame, cfg: Config) -> DataFrame:
    """Every bin of each day from 0 to its last, from activity (DAY, open_ns, close_ns, bin_idx, trades, updates): adds is_flush, is_gap, active, bin_end_ns, bin_mid_ns.

    A day's bins are few (at most a session over the bin size, 4680), so its windows are small.
    """
    day = Window.partitionBy(*DAY)
    before = F.coalesce(F.lag("bin_idx").over(day.orderBy("bin_idx")), F.lit(-1).cast("long"))
    ends = activity.withColumns({"max_bin": F.max("bin_idx").over(day), "own": F.col("bin_idx"), "gap_from": before + 1})
    # Each bin with records brings the empty ones before it along, so that the aggregation is used once and joined with nothing.
    out = ends.withColumn("bin_idx", F.explode(F.sequence("gap_from", "own")))
    recorded = F.col("bin_idx") == F.col("own")
    fixed = {*DAY, "bin_idx", "open_ns", "close_ns"}
    out = out.withColumns({c: F.when(recorded, F.col(c)) for c in activity.columns if c not in fixed} | {"recorded": F.when(recorded, F.lit(True))}).drop("own", "gap_from")
    flush = F.col("bin_idx") == F.col("max_bin")
    end = F.when(flush, F.col("close_ns")).otherwise(F.col("open_ns") + (F.col("bin_idx") + 1) * cfg.bin_ns)
    active = (F.coalesce("trades", F.lit(0)) > 0) | (F.coalesce("updates", F.lit(0)) > 0)
    out = out.withColumns({"is_flush": flush, "is_gap": ~flush & (F.col("bin_idx") > 0) & F.col("recorded").isNull(), "active": active, "bin_end_ns": end, "bin_mid_ns": end - cfg.bin_ns // 2})
    if not cfg.validation.auto_detect_close:
        return out.withColumn("cut", F.lit(None).cast("long")).drop("recorded")
    run = F.col("bin_idx") - F.coalesce(F.max(F.when(F.col("active"), F.col("bin_idx"))).over(day.orderBy("bin_idx").rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(-1))
    out = out.withColumn("run", run)
    cut = F.min(F.when(~F.col("is_flush") & ~F.col("active") & (F.col("run") >= cfg.validation.close_detection_gap_bins), F.col("bin_idx"))).over(day)
    return out.withColumn("cut", cut).drop("run", "recorded")


def emitted(grid: DataFrame, cfg: Config) -> DataFrame:
    """The processed bins with emit: bins up to the cut; the last one only without a cut and if anything happened in it; none in warm-up."""
    kept = grid.where(F.when(F.col("cut").isNotNull(), (F.col("bin_idx") <= F.col("cut")) & ~F.col("is_flush")).otherwise(~F.col("is_flush") | F.col("active")))
    return kept.withColumn("emit", F.col("bin_idx") >= cfg.validation.warmup_bins)


def with_volume_bins(trades: DataFrame, volume: int) -> DataFrame:
    """Adds volume_bin, the bin of equal traded volume in which each trade (DAY, seq, size) ends; the volume-driven counterpart of the time grid."""
    return trades.withColumn("volume_bin", F.floor((F.sum("size").over(up_to_now()) - 1) / F.lit(volume)))
