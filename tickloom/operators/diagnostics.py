"""Day summaries: what was seen, kept and left out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schema import DAY


def day_summary(bins: DataFrame, bin_ns: int, decode: DataFrame | None = None) -> DataFrame:
    """The 16 health counters of each day, from processed bins. Gap bins in warm-up count nowhere; records counted are accepted trades.

    decode: DAY, decode_errors, decode_truncated from the reader, if it counts them; null otherwise.
    """
    out_now, gap = F.col("emit"), F.col("is_gap")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = bins.groupBy(*DAY).agg(
        total("trades").alias("total_records_processed"),
        F.count_if(out_now).alias("total_bins_emitted"),
        F.count_if(out_now & (gap | (F.coalesce("trf_trades", F.lit(0)) == 0))).alias("total_empty_bins"),
        F.count_if(~out_now & ~gap & ~F.col("is_flush")).alias("warmup_bins_discarded"),
        F.count_if(out_now & gap).alias("gap_bins_emitted"),
        total("trf_trades").alias("total_trf_trades"),
        total("lit_trades").alias("total_lit_trades"),
        total("trades").alias("total_trade_records"),
        F.coalesce(F.min_by(F.col("bin_end_ns") - bin_ns, F.when(out_now, F.col("bin_idx"))), F.lit(0)).alias("first_bin_start_ns"),
        F.coalesce(F.min_by("bin_end_ns", F.when(out_now, F.col("bin_idx"))), F.lit(0)).alias("first_bin_end_ns"),
        F.coalesce(F.max_by("bin_end_ns", F.when(out_now, F.col("bin_idx"))), F.lit(0)).alias("last_bin_end_ns"),
        F.coalesce(F.sum("trf_vol"), F.lit(0.0)).alias("total_trf_volume"),
        F.coalesce(F.sum("lit_vol"), F.lit(0.0)).alias("total_lit_volume"),
        total("dropped").alias("dropped_invalid_price_trades"),
    )
    if decode is None:
        return sums.withColumns({"decode_errors": F.lit(None).cast("long"), "decode_truncated": F.lit(None).cast("boolean")})
    return sums.join(decode, DAY, "left").withColumns({"decode_errors": F.coalesce("decode_errors", F.lit(0)), "decode_truncated": F.coalesce("decode_truncated", F.lit(False))})
