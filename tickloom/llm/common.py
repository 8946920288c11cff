"""What the training-data operators share: the shared folder, written tables, Arrow maps."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space: the characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir); in tests, where it is unset, one of our own."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        found = "/tmp/checkpoints/tickloom"
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path through Hadoop's file systems, which know every scheme that Spark writes to."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/tickloom/{name}-{uuid.uuid4().hex}"

    def tidy() -> None:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before us; nothing depends on the removal
            pass

    atexit.register(tidy)
    return path


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """df, written as Parquet to the shared folder and read again: cuts lineage and outlives lost executors.

    Once it is written, nothing needs the shuffle files behind it, so Spark drops them at the end of the write.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before or "false")
    out = spark.read.schema(nullable(df.schema)).parquet(path)
    out._tickloom_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Removes written() tables that no lazy result still reads."""
    for df in tables:
        remove(df.sparkSession, df._tickloom_path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns of df can't clash with what an operator adds."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """df.mapInArrow with batches held to a size that whole long texts can't blow up.

    Spark cuts Arrow batches by rows and, since 4.0, by bytes; both bounds are set here, so that a task
    holds some 16 MB of input at a time whatever the length of the texts.
    """
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df.mapInArrow(fn, schema)


def batch_of(columns: dict[str, object], schema: pa.Schema) -> pa.RecordBatch:
    """A record batch with exactly schema's columns and types."""
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema], schema=schema)


def utf8(col: str) -> Column:
    """A text column as its UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(f"`{col}`").cast("binary"), F.lit(b"").cast("binary"))
