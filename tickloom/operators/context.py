"""Daily context: consolidated volume and prices of each day, and the join to whatever is by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.market import usd
from tickloom.schema import CONTEXT, DAY, DAY_NS


def daily_context(records: DataFrame) -> DataFrame:
    """One row per symbol and UTC date of ts_event_ns: the last record (by seq) wins. records: symbol, seq, ts_event_ns, volume, open/high/low/close in nano-dollars."""
    dated = records.withColumn("trade_date", F.date_from_unix_date(F.floor(F.col("ts_event_ns") / F.lit(DAY_NS)).cast("int")))
    row = F.struct("volume", *[usd(F.col(f"{p}_nano")).alias(p) for p in ("open", "high", "low", "close")])
    last = dated.groupBy(*DAY).agg(F.max_by(row, "seq").alias("c"))
    return last.select(*DAY, F.col("c.volume").alias("consolidated_volume"), "c.open", "c.high", "c.low", "c.close")


def empty_context(spark: SparkSession) -> DataFrame:
    """Every lookup then gives nulls."""
    return spark.createDataFrame([], CONTEXT)


def with_context(days: DataFrame, context: DataFrame) -> DataFrame:
    """days with their context, or nulls. A row a day of a symbol: Spark broadcasts it where its size allows and else joins by the day's own partitioning."""
    return days.join(context, DAY, "left")


def coverage(volumes: DataFrame, context: DataFrame) -> DataFrame:
    """Per day: off-exchange and lit volume against the consolidated one. volumes: DAY, trf_volume, lit_volume."""
    cv = F.when(F.col("consolidated_volume") > 0, F.col("consolidated_volume").cast("double"))
    return with_context(volumes, context).select(*DAY, "trf_volume", "lit_volume", "consolidated_volume", ((F.col("trf_volume") + F.col("lit_volume")) / cv).alias("coverage"), (F.col("trf_volume") / cv).alias("dark_share"))


def coverage_summary(by_day: DataFrame, low: float = 0.80, high: float = 0.86) -> DataFrame:
    have = by_day.where("coverage is not null").agg(
        F.count("*").alias("days"),
        F.avg("coverage").alias("mean_coverage"),
        F.min("coverage").alias("min_coverage"),
        F.max("coverage").alias("max_coverage"),
        F.avg("dark_share").alias("mean_dark_share"),
    )
    return have.withColumn("status", F.when(F.col("mean_coverage").between(low, high), "PASS").otherwise("WARNING"))


def fused(left: DataFrame, right: DataFrame, tolerance: float = 0.10) -> DataFrame:
    """Two exports of the same days joined by (DAY, bin_idx), without days whose bin counts differ by more than the tolerance. Clashing columns of right get the suffix _r."""
    counts = left.groupBy(*DAY).agg(F.count("*").alias("a")).join(right.groupBy(*DAY).agg(F.count("*").alias("b")), DAY)
    alike = counts.where(F.abs(F.col("a") - F.col("b")) <= F.greatest("a", "b") * tolerance).select(*DAY)
    keys = [*DAY, "bin_idx"]
    renamed = right.select(*keys, *[F.col(c).alias(f"{c}_r" if c in left.columns else c) for c in right.columns if c not in keys])
    return left.join(alike, DAY, "left_semi").join(renamed, keys)
