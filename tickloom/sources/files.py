"""File sources: discovery by date, Parquet and delimited events, tolerance of bad records, hashes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.calendar import from_file_date
from tickloom.schema import DAY, EVENTS
from tickloom.sources.stores import digests

#: Bad records in a row after which a day counts as cut off.
MOST_ERRORS = 1000


def discover(spark: SparkSession, data_dir: str, pattern: str) -> DataFrame:
    """(trade_date, path, bytes) of the files whose name matches the pattern with eight digits for {date}. Lists through Hadoop's file systems and reads no content."""
    if pattern.count("{date}") != 1:
        raise ValueError("the pattern needs exactly one {date}")
    head, tail = (re.escape(p) for p in pattern.split("{date}"))
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(data_dir)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        raise FileNotFoundError(data_dir)
    found = [(s.getPath().getName(), s.getPath().toString(), s.getLen()) for s in store.listStatus(root)]
    rows = [(m[1], path, size) for name, path, size in found if (m := re.fullmatch(f"{head}([0-9]{{8}}){tail}", name))]
    listed = spark.createDataFrame(rows, "day string, path string, bytes long")
    return listed.select(from_file_date(F.col("day")).alias("trade_date"), "path", "bytes").where("trade_date is not null").orderBy("trade_date", "path")


def read_events(spark: SparkSession, path: str | list[str], kind: str = "parquet") -> DataFrame:
    """Canonical events from Parquet or from delimited text with a header; a missing path is an error at once."""
    reader = spark.read.schema(EVENTS)
    paths = [path] if isinstance(path, str) else path
    return reader.parquet(*paths) if kind == "parquet" else reader.option("header", True).csv(paths)


def read_tolerant(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Delimited events with bad rows kept as such in _corrupt_record; their seq, if readable, tells their place."""
    schema = T.StructType([*EVENTS.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").csv(path)


def decode_report(rows: DataFrame, most: int = MOST_ERRORS) -> tuple[DataFrame, DataFrame]:
    """(good rows, DAY with decode_errors and decode_truncated). A day is cut off at its first run of `most` bad rows."""
    # The reader checks only columns that are used; this uses all of them, so that a row counts the same whatever is selected later.
    every = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).bitwiseAND(0) == 0
    bad = F.col("_corrupt_record").isNotNull() & every
    order = Window.partitionBy(*DAY).orderBy("seq")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = rows.withColumn("_bad", bad).withColumn("_island", F.sum(F.when(F.col("_bad"), 0).otherwise(1)).over(so_far))
    marked = marked.withColumn("_run", F.sum(F.col("_bad").cast("long")).over(Window.partitionBy(*DAY, "_island").orderBy("seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    marked = marked.withColumn("_over", F.max(F.when(F.col("_run") >= most, 1).otherwise(0)).over(so_far))
    report = marked.where((F.col("_over") == 0) | (F.col("_run") == most)).groupBy(*DAY).agg(F.count_if("_bad").alias("decode_errors"), (F.max("_over") == 1).alias("decode_truncated"))
    good = marked.where("not _bad and _over = 0").drop("_corrupt_record", "_bad", "_island", "_run", "_over")
    return good, report


def in_memory(spark: SparkSession, rows: list, schema: T.StructType = EVENTS) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of each file; each is streamed by one task, whatever its size."""
    return digests(spark.read.format("binaryFile").load(path).select("path"))
