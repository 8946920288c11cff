"""Sliding windows of feature vectors that end at a bin with all labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.labels import in_order
from tickloom.schema import DAY, FEATURES


def sequence_index(labelled: DataFrame, window: int, stride: int) -> DataFrame:
    """The bins at which a sequence ends, with position (among the day's emitted bins) and first_position."""
    out = labelled.withColumn("position", F.row_number().over(in_order()) - 1)
    out = out.withColumn("first_position", F.col("position") - (window - 1))
    return out.where((F.col("first_position") >= 0) & F.col("label_valid") & (F.col("first_position") % stride == 0))


def sequences(labelled: DataFrame, window: int, stride: int, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """sequence_index() with sequence: array of window arrays of the features.

    A day has at most some thousand bins, so the window times the features of a day stay a few megabytes.
    """
    frame = in_order().rowsBetween(-(window - 1), Window.currentRow)
    gathered = labelled.withColumn("sequence", F.collect_list(F.array(*[F.col(f) for f in features])).over(frame))
    return sequence_index(gathered, window, stride)


def sequence_counts(labelled: DataFrame, window: int, stride: int) -> DataFrame:
    return sequence_index(labelled, window, stride).groupBy(*DAY).agg(F.count("*").alias("n_sequences"))
