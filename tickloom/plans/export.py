"""Export: sequences, labels and forward prices as arrays, with metadata, statistics and diagnostics beside them.

A day of a symbol is one export unit. Bins are computed once and written; sequences, statistics, labels and diagnostics branch from there
and meet in one row a day, which the dataset sink takes. Parquet is the native sink for the same content.
"""

from __future__ import annotations

import json
import subprocess
from datetime import UTC, datetime
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import tickloom
from tickloom.config import Config
from tickloom.functions.market import split_of
from tickloom.operators import diagnostics, labels, normalize, sequences
from tickloom.plans import dataset, day, manifest
from tickloom.schema import CATEGORICAL, CONTRACT_VERSION, DAY, DIAGNOSTICS_VERSION, FEATURES, SCHEMA_VERSION
from tickloom.sources.stores import stored

KINDS = dataset.KINDS


def labelled_bins(bins: DataFrame, cfg: Config) -> DataFrame:
    h = cfg.labeling.horizons
    return labels.with_forward_prices(labels.with_labels(bins, h), max(h))


def sequence_rows(bins: DataFrame, cfg: Config) -> DataFrame:
    """One row a sequence: DAY, bin_idx, sequence, labels, forward_prices, split; z-scored if configured."""
    ready = labelled_bins(bins, cfg)
    if cfg.export.normalization == "per_day_zscore":
        ready = normalize.normalized(ready)
    elif cfg.export.normalization == "global_zscore":
        ready = normalize.globally_normalized(ready, split_of(F.col("trade_date"), *cfg.export.split_dates) == "train")
    rows = sequences.sequences(ready, cfg.sequence.window_size, cfg.sequence.stride)
    split = split_of(F.col("trade_date"), *cfg.export.split_dates)
    return rows.select(*DAY, "bin_idx", "sequence", F.array(*[f"label_{h}" for h in cfg.labeling.horizons]).alias("labels"), "forward_prices", split.alias("split"))


@lru_cache(maxsize=1)
def _commit() -> tuple[str, bool]:
    """The commit that this code is of, and whether files differ from it; unknown where there is no repository."""
    git = lambda *args: subprocess.run(["git", *args], cwd=Path(__file__).parent, capture_output=True, text=True, timeout=10, check=True).stdout.strip()
    try:
        return git("rev-parse", "HEAD") or "unknown", bool(git("status", "--porcelain", "--untracked-files=no"))
    except (OSError, subprocess.SubprocessError):
        return "unknown", False


def written_by() -> dict:
    """What wrote a dataset, for its manifest."""
    commit, dirty = _commit()
    return {"schema_version": f"{SCHEMA_VERSION:.1f}", "contract_version": CONTRACT_VERSION, "feature_count": len(FEATURES), "processor_version": tickloom.__version__, "git_commit": commit, "git_dirty": dirty, "export_timestamp": datetime.now(UTC).isoformat()}


def metadata(day_: str, counts: dict, cfg: Config, context: dict | None = None, source: dict | None = None) -> dict:
    """The metadata document of a day. source: source_file, data_file_sha256 and commit, as far as they are known."""
    h = list(cfg.labeling.horizons)
    source = source or {}
    now = datetime.now(UTC).isoformat()
    commit, dirty = source.get("commit") or _commit()
    provenance = {"source_file": source.get("source_file") or "", "processor_version": tickloom.__version__, "git_commit": commit, "git_dirty": dirty, "export_timestamp_utc": now, "config_hash": cfg.hash()}
    if source.get("data_file_sha256"):
        provenance["data_file_sha256"] = source["data_file_sha256"]
    return {
        "day": day_,
        "symbol": cfg.input.symbol,
        "n_sequences": counts["n_sequences"],
        "window_size": cfg.sequence.window_size,
        "stride": cfg.sequence.stride,
        "n_features": len(FEATURES),
        "feature_names": list(FEATURES),
        "horizons": h,
        "bin_size_seconds": cfg.sampling.bin_size_seconds,
        "market_open_et": cfg.sampling.market_open_et,
        "schema_version": f"{SCHEMA_VERSION:.1f}",
        "contract_version": CONTRACT_VERSION,
        "data_source": cfg.input.data_source,
        "schema": cfg.input.record_schema,
        "experiment": cfg.export.experiment,
        "label_strategy": cfg.labeling.label_type,
        "label_type": cfg.labeling.label_type,
        "label_encoding": "continuous_bps",
        "forward_prices": {"exported": True, "max_horizon": max(h), "n_columns": max(h) + 1, "units": "USD", "column_layout": "column_0_is_base_price_at_t; column_h_is_price_at_t_plus_h", "smoothing_window_offset": 0},
        "normalization": {"strategy": cfg.export.normalization, "applied": cfg.export.normalization != "none", "params_file": f"{cfg.input.symbol}_{day_.replace('-', '')}_{KINDS[4]}", "not_normalized": [FEATURES.index(f) for f in FEATURES if f in CATEGORICAL]},
        "signing_method": cfg.classification.signing_method,
        "exclusion_band": cfg.classification.exclusion_band,
        "feature_groups_enabled": cfg.to_dict()["features"],
        "classification_config": cfg.to_dict()["classification"],
        "provenance": provenance,
        "export_timestamp": now,
        "context_available": bool(context and context.get("consolidated_volume")),
        "consolidated_volume": (context or {}).get("consolidated_volume"),
        "trf_volume_fraction": (context or {}).get("trf_volume_fraction"),
        **{k: v for k, v in counts.items() if k != "n_sequences"},
    }


def documents_of(row: dict, n_sequences: int, cfg: Config) -> dict[str, dict]:
    """The three documents of a day, from its row."""
    s, day_ = json.loads(row["summary"]), f"{row['trade_date']:%Y-%m-%d}"
    tally = {"n_sequences": n_sequences, "n_bins_total": s["total_bins_emitted"], "n_bins_valid": int(row["n_valid"]), "n_bins_warmup_discarded": s["warmup_bins_discarded"], "n_bins_label_truncated": int(row["n_truncated"]), "n_total_records": s["total_records_processed"], "n_trade_records": s["total_trade_records"], "n_trf_trades": s["total_trf_trades"], "n_lit_trades": s["total_lit_trades"], "first_bin_start_ns": s["first_bin_start_ns"], "last_bin_end_ns": s["last_bin_end_ns"]}
    volume = row.get("consolidated_volume")
    known = {"consolidated_volume": int(volume), "trf_volume_fraction": s["total_trf_volume"] / volume if volume else None} if volume is not None else None
    source = {"source_file": row.get("source_file"), "data_file_sha256": row.get("data_file_sha256"), "commit": (row["git_commit"], row["git_dirty"])}
    return {
        "metadata.json": metadata(day_, tally, cfg, known, source),
        "normalization.json": {"day": day_, "strategy": cfg.export.normalization, "features": json.loads(row["stats"])},
        "diagnostics.json": {"schema_version": DIAGNOSTICS_VERSION, "day": day_, "summary": s},
    }


def day_rows(events: DataFrame, cfg: Config, context: DataFrame | None = None, decode: DataFrame | None = None, sources: DataFrame | None = None) -> DataFrame:
    """One row a day of a symbol, with all that its files need. The bins are computed here, once.

    decode: counters of bad rows by DAY, where the source counts them. sources: (trade_date, source_file, data_file_sha256), where days are files.
    """
    processed = stored(day.all_bins(events, cfg, context), "bins")
    bins = processed.where("emit")
    h = cfg.labeling.horizons
    rows = sequence_rows(bins, cfg).groupBy(*DAY, "split").agg(F.sort_array(F.collect_list(F.struct("bin_idx", "sequence", "labels", "forward_prices"))).alias("rows"))
    summary = diagnostics.day_summary(processed, cfg.bin_ns, decode)
    stats = normalize.feature_stats(bins).groupBy(*DAY).agg(F.to_json(F.sort_array(F.collect_list(F.struct("feature_idx", "feature", *normalize.STATS)))).alias("stats"))
    counts = labels.label_summary(labels.with_labels(bins, h), h)
    names = [c for c in summary.columns if c not in DAY]
    joined = summary.select(*DAY, F.to_json(F.struct(*names)).alias("summary")).join(counts, DAY).join(stats, DAY).join(rows, DAY, "left")
    commit, dirty = _commit()
    joined = joined.withColumns({"split": F.coalesce("split", split_of(F.col("trade_date"), *cfg.export.split_dates)), "git_commit": F.lit(commit), "git_dirty": F.lit(dirty)})
    if context is not None:
        joined = joined.join(context.select(*DAY, "consolidated_volume"), DAY, "left")
    return joined if sources is None else joined.join(sources, "trade_date", "left")


def export_dataset(events: DataFrame, cfg: Config, root: str, context: DataFrame | None = None, decode: DataFrame | None = None, sources: DataFrame | None = None) -> dict:
    """Exports every day of events below root, a path or URI that driver and tasks share, and returns the manifest.

    With continue_on_error a day's error is listed in the manifest, else it ends the job and leaves nothing.
    """
    spark = events.sparkSession
    spark.dataSource.register(dataset.DatasetSink)
    rows = day_rows(events, cfg, context, decode, sources)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "1")  # a day is megabytes
    try:
        rows.write.format(dataset.FORMAT).mode("append").option("root", root).option("config", json.dumps(cfg.to_dict())).save()
    finally:
        spark.conf.set(key, before)
    return manifest.read(root)


def export_parquet(bins: DataFrame, cfg: Config, path: str) -> None:
    """The same sequences as Parquet, partitioned by split and day."""
    sequence_rows(bins, cfg).write.mode("errorifexists").partitionBy("split", "trade_date").parquet(path)
