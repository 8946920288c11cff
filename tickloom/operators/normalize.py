"""Statistics of the features by day, in long form, and z-scores by them.

A row for each bin and feature, and few aggregates over them: plans stay small, however many features there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.market import zscore
from tickloom.schema import CATEGORICAL, DAY, FEATURES

STATS = ("mean", "std", "min", "max", "n_finite", "n_nan")


def _named(features: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*map(F.lit, features)), F.col("feature_idx") + 1).alias("feature")


def feature_stats(bins: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(DAY, feature_idx, feature, mean, std, min, max, n_finite, n_nan) over all emitted bins."""
    long = bins.select(*DAY, F.posexplode(F.array(*[F.col(f).cast("double") for f in features])).alias("feature_idx", "value"))
    c = F.col("value")
    ok = F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False))
    x = F.when(ok, c)
    stats = long.groupBy(*DAY, "feature_idx").agg(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("n_finite"), F.count_if(~ok).alias("n_nan"))
    return stats.select(*DAY, "feature_idx", _named(features), *STATS)


def _in_a_row(stats: DataFrame, keys: list[str], *names: str) -> DataFrame:
    """One row for keys with _stats: an array of structs in the features' order."""
    return stats.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("feature_idx", *names))).alias("_stats"))


def _scored(features: tuple[str, ...], off: set[str]) -> dict[str, Column]:
    scored = [f for f in features if f not in CATEGORICAL and f not in off]
    return {f: zscore(F.col(f), F.col("_stats")[features.index(f)].mean, F.col("_stats")[features.index(f)].std) for f in scored}


def normalized(bins: DataFrame, off: set[str] = frozenset(), features: tuple[str, ...] = FEATURES) -> DataFrame:
    """bins with each feature as its day's z-score; categorical features, and those of groups that are off, stay as they are.

    The statistics are a row a day and join on the day.
    """
    stats = _in_a_row(feature_stats(bins, features), list(DAY), "mean", "std")
    return bins.join(stats, DAY).withColumns(_scored(features, off)).drop("_stats")


def day_moments(bins: DataFrame, features: tuple[str, ...] = FEATURES) -> DataFrame:
    """(DAY, feature_idx, feature, n, mean, m2) over finite values. Moments merge, so days are read once whatever is asked of them."""
    std = F.coalesce("std", F.lit(0.0))
    return feature_stats(bins, features).select(*DAY, "feature_idx", "feature", F.col("n_finite").alias("n"), F.coalesce("mean", F.lit(0.0)).alias("mean"), (std * std * F.col("n_finite")).alias("m2"))


def merged_moments(moments: DataFrame) -> DataFrame:
    """(feature_idx, feature, n, mean, m2) over all days, from theirs. Means are taken before squares, so nothing cancels."""
    key = ["feature_idx", "feature"]
    total = moments.groupBy(*key).agg(F.sum("n").alias("all"), (F.sum(F.col("n") * F.col("mean")) / F.greatest(F.sum("n"), F.lit(1))).alias("centre"))
    off = F.col("mean") - F.col("centre")
    return moments.join(total, key).groupBy(*key).agg(F.first("all").alias("n"), F.first("centre").alias("mean"), F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"))


def globally_normalized(bins: DataFrame, training: Column, off: set[str] = frozenset(), features: tuple[str, ...] = FEATURES) -> DataFrame:
    """bins with each feature as its z-score against all bins of the days where `training` holds; other days are scaled, but give nothing to the statistics.

    Of the same categorical features, and groups that are off, as normalized(). Without a training day nothing can be scaled, and features are null.
    """
    std = F.sqrt(F.col("m2") / F.greatest("n", F.lit(1)))
    whole = _in_a_row(merged_moments(day_moments(bins.where(training), features)).select(F.lit(1).alias("_all"), "feature_idx", "mean", std.alias("std")), ["_all"], "mean", "std")  # one row
    return bins.withColumn("_all", F.lit(1)).join(F.broadcast(whole), "_all", "left").withColumns(_scored(features, off)).drop("_stats", "_all")
