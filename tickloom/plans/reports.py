"""Reports over days: coverage against consolidated volume, and a profile of what each day holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.config import Config
from tickloom.operators import context as daily
from tickloom.operators import diagnostics, labels, sequences
from tickloom.plans import day
from tickloom.schema import DAY


def coverage_report(events: DataFrame, context: DataFrame, cfg: Config) -> DataFrame:
    summary = diagnostics.day_summary(day.processed_bins(events, cfg), cfg.bin_ns)
    return daily.coverage(summary.select(*DAY, F.col("total_trf_volume").alias("trf_volume"), F.col("total_lit_volume").alias("lit_volume")), context)


def profile_report(events: DataFrame, cfg: Config) -> DataFrame:
    processed = day.processed_bins(events, cfg)
    summary = diagnostics.day_summary(processed, cfg.bin_ns)
    counted = sequences.sequence_counts(labels.with_labels(processed.where("emit").select(*DAY, "bin_idx", "mid_price"), cfg.labeling.horizons), cfg.sequence.window_size, cfg.sequence.stride)
    return summary.join(counted, DAY, "left").select(
        *DAY,
        F.col("total_records_processed").alias("records"),
        F.col("total_trade_records").alias("trades"),
        F.col("total_trf_trades").alias("trf_trades"),
        F.col("total_lit_trades").alias("lit_trades"),
        F.col("total_bins_emitted").alias("bins"),
        F.col("total_empty_bins").alias("empty_bins"),
        F.coalesce("n_sequences", F.lit(0)).alias("sequences"),
    )
