"""Trading calendar: weekdays, holidays, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.market import split_of


def weekdays(spark: SparkSession, start: str, end: str, exclude: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """(trade_date) Monday to Friday from start to end, both included, without the excluded ones."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("trade_date"))
    days = days.where(~F.dayofweek("trade_date").isin(1, 7))
    if exclude:
        off = spark.createDataFrame([(d,) for d in exclude], "d string").select(F.col("d").cast("date").alias("trade_date"))
        days = days.join(off, "trade_date", "left_anti")
    return days


def with_split(days: DataFrame, train_end: str, val_end: str) -> DataFrame:
    return days.withColumn("split", split_of(F.col("trade_date"), train_end, val_end))


def file_date(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")


def from_file_date(text: Column) -> Column:
    """The date of YYYYMMDD; null if it is none."""
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def available(days: DataFrame, files: DataFrame) -> DataFrame:
    """days with a file; files: (trade_date, path)."""
    return days.join(files, "trade_date")


def missing(days: DataFrame, files: DataFrame) -> DataFrame:
    return days.join(files, "trade_date", "left_anti")
