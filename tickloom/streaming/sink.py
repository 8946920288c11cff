"""A sink that holds every batch exactly once, however often one is replayed.

A batch's rows go to a folder of its query and number, written anew by each attempt; then a mark with the number is put beside
it. Marks are what readers go by: a batch without one is not there yet, one with it is not written again. A query is known by the id
in its checkpoint, so another query on the same table, or the same one begun anew, has numbers of its own.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKS = "_marks"


def _store(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a query keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def marks(spark: SparkSession, path: str) -> dict[str, int]:
    """The last committed batch of each query."""
    store, root = _store(spark, f"{path}/{_MARKS}")
    found: dict[str, int] = {}
    for mark in store.listStatus(root) if store.exists(root) else ():
        query, _, batch = mark.getPath().getName().rpartition(".")
        found[query] = max(found.get(query, -1), int(batch))
    return found


def _mark(spark: SparkSession, path: str, query: str, batch: int) -> None:
    """Puts the batch's mark, which is one operation of the file system, and takes the one before it away."""
    store, target = _store(spark, f"{path}/{_MARKS}/{query}.{batch}")
    store.create(target, True).close()
    store.delete(_store(spark, f"{path}/{_MARKS}/{query}.{batch - 1}")[1], False)


def committing(path: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch."""

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = query_id(spark, checkpoint)
        if number <= marks(spark, path).get(query, -1):
            return
        batch.write.mode("overwrite").parquet(f"{path}/query={query}/batch={number}")
        _mark(spark, path, query, number)

    return put


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """All that is there now, to the table at path."""
    stream.writeStream.outputMode(mode).foreachBatch(committing(path, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def committed(spark: SparkSession, path: str, latest: bool = False) -> DataFrame:
    """The rows of all committed batches; latest: of each query's last one, for streams that give their whole result each time."""
    rows, there = spark.read.parquet(path), F.lit(False)
    for query, batch in marks(spark, path).items():  # one entry a query
        there = there | ((F.col("query") == query) & (F.col("batch") == batch if latest else F.col("batch") <= batch))
    return rows.where(there).drop("query", "batch")
