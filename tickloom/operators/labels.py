"""Labels and forward prices over a day's emitted bins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.schema import DAY, EPS


def in_order():
    return Window.partitionBy(*DAY).orderBy("bin_idx")


def with_labels(bins: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """Adds label_<h> in basis points (null where undefined) and label_valid (all are defined)."""
    mid = F.col("mid_price")
    usable = F.abs(mid) >= EPS

    def label(h: int):
        then = F.lead("mid_price", h).over(in_order())
        return F.when(usable, (then - mid) / F.when(usable, mid) * 10_000.0)

    out = bins.withColumns({f"label_{h}": label(h) for h in horizons})
    valid = F.lit(True)
    for h in horizons:
        valid = valid & F.col(f"label_{h}").isNotNull()
    return out.withColumn("label_valid", valid)


def with_forward_prices(bins: DataFrame, most: int) -> DataFrame:
    """Adds forward_prices: the mid prices 0..most bins ahead, null beyond the day or where there is none."""
    ahead = F.collect_list(F.coalesce(F.when(F.abs("mid_price") > EPS, F.col("mid_price")), F.lit(float("nan")))).over(in_order().rowsBetween(0, most))
    padded = F.concat(F.col("_ahead"), F.array_repeat(F.lit(float("nan")), most + 1 - F.size("_ahead")))
    return bins.withColumn("_ahead", ahead).withColumn("forward_prices", F.transform(padded, lambda x: F.when(~F.isnan(x), x))).drop("_ahead")


def label_summary(labelled: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """Per day: bins, valid ones and those cut off by the end of the day."""
    return labelled.groupBy(*DAY).agg(F.count("*").alias("n_bins"), F.count_if("label_valid").alias("n_valid"), F.count_if(~F.col("label_valid")).alias("n_truncated"))
