"""Configuration: typed sections, checked values, TOML in, a stable hash out."""

from __future__ import annotations

import dataclasses
import hashlib
import json
import math
import re
import tomllib
from dataclasses import dataclass, field
from datetime import date, datetime
from pathlib import Path

from tickloom.schema import DEFAULT_HORIZONS


class ConfigError(ValueError):
    """A setting that can't be worked with."""


def seconds_of(clock: str) -> int:
    """Seconds since midnight of HH:MM."""
    m = re.fullmatch(r"(\d{1,2}):(\d{2})", clock)
    if not m or int(m[1]) > 23 or int(m[2]) > 59:
        raise ConfigError(f"not a time of day: {clock!r}")
    return int(m[1]) * 3600 + int(m[2]) * 60


def _check(ok: bool, message: str) -> None:
    if not ok:
        raise ConfigError(message)


@dataclass(frozen=True)
class Input:
    data_dir: str = "."
    filename_pattern: str = "{date}.parquet"
    symbol: str = "SYN"
    daily_summary_path: str | None = None
    data_source: str = "XNAS.BASIC"
    record_schema: str = "cmbp-1"

    def __post_init__(self) -> None:
        _check(self.filename_pattern.count("{date}") == 1, "filename_pattern needs exactly one {date}")
        _check(bool(self.symbol), "symbol is empty")


@dataclass(frozen=True)
class Sampling:
    strategy: str = "time_based"
    bin_size_seconds: int = 60
    market_open_et: str = "09:30"
    market_close_et: str = "16:00"

    def __post_init__(self) -> None:
        _check(self.strategy == "time_based", f"unknown sampling strategy {self.strategy!r}")
        _check(self.bin_size_seconds in {5, 10, 15, 30, 60, 120, 300, 600}, f"bin size {self.bin_size_seconds} isn't allowed")
        _check(seconds_of(self.market_open_et) < seconds_of(self.market_close_et), "the market closes before it opens")


@dataclass(frozen=True)
class Classification:
    signing_method: str = "midpoint"
    exclusion_band: float = 0.10
    lower: float = 0.001
    upper_sell: float = 0.40
    lower_buy: float = 0.60
    upper: float = 0.999

    def __post_init__(self) -> None:
        _check(self.signing_method == "midpoint", f"signing method {self.signing_method!r} isn't implemented")
        _check(0 <= self.exclusion_band <= 0.5, "exclusion_band is outside [0, 0.5]")
        _check(0 < self.lower < self.upper_sell < self.lower_buy < self.upper < 1, "retail bounds are out of order")


@dataclass(frozen=True)
class Features:
    signed_flow: bool = True
    venue_metrics: bool = True
    retail_metrics: bool = True
    bbo_dynamics: bool = True
    vpin: bool = False
    trade_size: bool = True
    cross_venue: bool = True


@dataclass(frozen=True)
class Vpin:
    bucket_volume: int = 5000
    lookback_buckets: int = 50
    sigma_window_minutes: int = 1
    bucket_volume_fraction: float | None = None

    def __post_init__(self) -> None:
        _check(self.bucket_volume > 0 and self.lookback_buckets > 0 and self.sigma_window_minutes > 0, "vpin sizes must be positive")
        f = self.bucket_volume_fraction
        _check(f is None or (math.isfinite(f) and 0 <= f <= 1), "bucket_volume_fraction is outside [0, 1]")


@dataclass(frozen=True)
class Validation:
    min_trades_per_bin: int = 10
    bbo_staleness_max_ns: int = 5_000_000_000
    warmup_bins: int = 3
    block_threshold: int = 10_000
    burst_threshold: int = 20
    burst_window_ns: int = 1_000_000_000
    empty_bin_policy: str = "forward_fill_state"
    auto_detect_close: bool = True
    close_detection_gap_bins: int = 10

    def __post_init__(self) -> None:
        _check(self.empty_bin_policy == "forward_fill_state", f"unknown empty-bin policy {self.empty_bin_policy!r}")
        _check(self.warmup_bins >= 0 and self.min_trades_per_bin >= 0, "negative counts")
        _check(self.burst_threshold >= 2 and self.close_detection_gap_bins >= 1 and self.block_threshold >= 1, "thresholds are too small")


@dataclass(frozen=True)
class Sequence:
    window_size: int = 20
    stride: int = 1

    def __post_init__(self) -> None:
        _check(1 <= self.stride <= self.window_size, "stride must be in 1..window_size")


@dataclass(frozen=True)
class Labeling:
    label_type: str = "point_return"
    horizons: tuple[int, ...] = DEFAULT_HORIZONS

    def __post_init__(self) -> None:
        object.__setattr__(self, "horizons", tuple(self.horizons))
        _check(self.label_type == "point_return", f"unknown label type {self.label_type!r}")
        _check(bool(self.horizons) and all(1 <= h <= 200 for h in self.horizons), "horizons must be within 1..200")
        _check(all(a < b for a, b in zip(self.horizons, self.horizons[1:])), "horizons must ascend")


def iso(text: str) -> date:
    try:
        return datetime.strptime(text, "%Y-%m-%d").date()
    except ValueError as e:
        raise ConfigError(f"not a date: {text!r}") from e


@dataclass(frozen=True)
class Dates:
    start_date: str = "2024-01-01"
    end_date: str = "2024-01-31"
    exclude_dates: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "exclude_dates", tuple(self.exclude_dates))
        _check(iso(self.start_date) <= iso(self.end_date), "the dates end before they start")
        for d in self.exclude_dates:
            iso(d)


@dataclass(frozen=True)
class Export:
    output_dir: str = "export"
    split_dates: tuple[str, str] = ("2024-01-20", "2024-01-25")
    normalization: str = "none"
    experiment: str = "default"
    continue_on_error: bool = True

    def __post_init__(self) -> None:
        object.__setattr__(self, "split_dates", tuple(self.split_dates))
        _check(len(self.split_dates) == 2 and iso(self.split_dates[0]) < iso(self.split_dates[1]), "split_dates must be the ends of train and of validation, in order")
        _check(self.normalization in {"none", "per_day_zscore", "global_zscore"}, f"unknown normalization {self.normalization!r}")


@dataclass(frozen=True)
class Config:
    input: Input = field(default_factory=Input)
    sampling: Sampling = field(default_factory=Sampling)
    classification: Classification = field(default_factory=Classification)
    features: Features = field(default_factory=Features)
    vpin: Vpin = field(default_factory=Vpin)
    validation: Validation = field(default_factory=Validation)
    sequence: Sequence = field(default_factory=Sequence)
    labeling: Labeling = field(default_factory=Labeling)
    dates: Dates = field(default_factory=Dates)
    export: Export = field(default_factory=Export)

    @classmethod
    def from_dict(cls, values: dict) -> Config:
        """Unknown sections and keys are errors, but for keys of [classification]."""
        sections = {f.name: f.default_factory for f in dataclasses.fields(cls)}
        _check(set(values) <= set(sections), f"unknown sections {sorted(set(values) - set(sections))}")
        out = {}
        for name, kind in sections.items():
            given = values.get(name, {})
            known = {f.name for f in dataclasses.fields(kind)}
            if name == "classification":
                given = {k: v for k, v in given.items() if k in known}
            _check(set(given) <= known, f"unknown keys in [{name}]: {sorted(set(given) - known)}")
            out[name] = kind(**given)
        return cls(**out)

    @classmethod
    def from_toml(cls, path: str | Path) -> Config:
        return cls.from_dict(tomllib.loads(Path(path).read_text()))

    def with_(self, **sections: dict) -> Config:
        """A copy with some keys of some sections changed."""
        return dataclasses.replace(self, **{name: dataclasses.replace(getattr(self, name), **keys) for name, keys in sections.items()})

    def to_dict(self) -> dict:
        return dataclasses.asdict(self)

    def hash(self) -> str:
        """SHA-256 over what decides the result; where it is written doesn't."""
        kept = self.to_dict()
        kept["export"].pop("output_dir")
        return hashlib.sha256(json.dumps(kept, sort_keys=True, separators=(",", ":"), default=list).encode()).hexdigest()

    @property
    def bin_ns(self) -> int:
        return self.sampling.bin_size_seconds * 1_000_000_000

    @property
    def session_ns(self) -> int:
        return (seconds_of(self.sampling.market_close_et) - seconds_of(self.sampling.market_open_et)) * 1_000_000_000
