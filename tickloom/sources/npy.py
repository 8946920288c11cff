"""Exported arrays, read again as rows: tasks take the days that the manifest lists, one at a time."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from tickloom.plans import manifest
from tickloom.schema import FEATURES
from tickloom.sources.stores import get


def _days(spark: SparkSession, root: str) -> DataFrame:
    """(name, split) of every exported day with sequences."""
    found = manifest.read(root)
    rows = [(f.rpartition("/")[2].removesuffix("_diagnostics.json"), f.partition("/")[0]) for f in found["diagnostics_files"]]
    return spark.createDataFrame(rows, "name string, split string").repartition("name")


def _loaded(root: str, split: str, name: str, kind: str) -> np.ndarray:
    return np.load(io.BytesIO(get(f"{root.rstrip('/')}/{split}/{name}_{kind}")))


def read_sequences(spark: SparkSession, root: str) -> DataFrame:
    """(symbol, trade_date, split, n, step, the features): a row for each step of each sequence."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, split in (r for f in frames for r in f.itertuples(index=False)):
            a = _loaded(root, split, name, "sequences.npy").astype(np.float64)
            n, steps = np.divmod(np.arange(a.shape[0] * a.shape[1]), a.shape[1])
            yield pd.DataFrame({"symbol": name[:-9], "trade_date": pd.to_datetime(name[-8:]).date(), "split": split, "n": n, "step": steps} | dict(zip(FEATURES, a.reshape(-1, a.shape[2]).T, strict=True)))

    return _days(spark, root).mapInPandas(run, "symbol string, trade_date date, split string, n long, step long, " + ", ".join(f"{f} double" for f in FEATURES))


def read_targets(spark: SparkSession, root: str, horizons: tuple[int, ...]) -> DataFrame:
    """(symbol, trade_date, split, n, label_<h>, price_<k>): a row for each sequence; null where an array has none."""
    labels, prices = [f"label_{h}" for h in horizons], [f"price_{k}" for k in range(max(horizons) + 1)]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for name, split in (r for f in frames for r in f.itertuples(index=False)):
            both = np.hstack([_loaded(root, split, name, "labels.npy"), _loaded(root, split, name, "forward_prices.npy")])
            columns = {c: pd.array(v, dtype="Float64") for c, v in zip([*labels, *prices], np.where(np.isnan(both), None, both).T, strict=True)}
            yield pd.DataFrame({"symbol": name[:-9], "trade_date": pd.to_datetime(name[-8:]).date(), "split": split, "n": np.arange(len(both))} | columns)

    return _days(spark, root).mapInPandas(run, "symbol string, trade_date date, split string, n long, " + ", ".join(f"{c} double" for c in [*labels, *prices]))
