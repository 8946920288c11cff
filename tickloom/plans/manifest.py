"""The dataset manifest: what was exported, by split, and what failed."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.sources import stores

NAME = "dataset_manifest.json"


def guard(root: str, force: bool = False) -> None:
    """Refuses a folder that already has a manifest."""
    if stores.exists(f"{root.rstrip('/')}/{NAME}") and not force:
        raise FileExistsError(f"{root} already holds an export; force overwrites it")


def read(root: str) -> dict:
    return json.loads(stores.get(f"{root.rstrip('/')}/{NAME}"))


def split_totals(days: DataFrame) -> DataFrame:
    """(split, n_days, n_sequences, first_date, last_date) of days (split, trade_date, n_sequences)."""
    return days.groupBy("split").agg(F.count("*").alias("n_days"), F.coalesce(F.sum("n_sequences"), F.lit(0)).alias("n_sequences"), F.min("trade_date").alias("first_date"), F.max("trade_date").alias("last_date"))
