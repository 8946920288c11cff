"""Exact deduplication by content sort.

Every row is keyed by the first characters of its normalised text, the SHA-256 of the rest of it, and its
rank within a group (most code points first, then smallest identifier). Spark samples these short keys for splitters and
range-partitions by them, so a group of copies that holds a third of all rows is cut over many partitions.
External sorting places equals next to each other; one pass compares neighbours in full. Runs that touch a
partition's edge are joined up over a table of at most two rows a partition.

Defined results: a null text counts as empty, and empty texts equal each other. Of equal texts the row with
the most code points in the original stays, then the smallest identifier; null identifiers come last. Of
rows that are alike in both, exactly one stays. An empty table gives an empty table. Extra columns ride along
(carry) under their own names or are dropped, so they can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import SPACES, table, utf8, written

#: Characters of the normalised text at the head of the sort key. They bound the splitters that Spark samples; the digest orders what they leave equal.
KEY_CHARS = 32

_OUT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("digest", T.StringType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("run", T.LongType()),
        T.StructField("edge", T.BooleanType()),
        T.StructField("head", T.BooleanType()),
        T.StructField("run_keep", T.LongType()),
        T.StructField("run_size", T.LongType()),
    ]
)


def _runs(carried: pa.DataType):
    """Cuts a sorted partition into runs of equal texts. Holds one text, and the identifiers of one run."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, last, digest, ids, head = 0, None, None, [], None
        ready: list[tuple] = []

        def close(edge: bool) -> None:
            keep, size = ids[0], len(ids)
            ready.extend((i, digest, part, run, edge, k == 0, keep, size, head if k == 0 else None) for k, i in enumerate(ids))

        def flush() -> pa.RecordBatch:
            names = [*_OUT.names, "row"]
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), carried]
            out = pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(zip(*ready, strict=True), types, strict=True)], names=names)
            ready.clear()
            return out

        held = 0
        for batch in batches:
            texts, digests, keys = batch.column("norm").to_pylist(), batch.column("digest").to_pylist(), batch.column("id").to_pylist()
            rows = batch.column("row")
            for k, text in enumerate(texts):
                if last is not None and text == last:
                    ids.append(keys[k])
                    continue
                if last is not None:
                    close(run == 0)
                    run += 1
                last, digest, ids, head = text, digests[k], [keys[k]], rows[k].as_py()
                held += len(text)
                if len(ready) >= 5000 or held > 8 << 20:
                    if ready:
                        yield flush()
                    held = 0
        if last is not None:
            close(True)
        if ready:
            yield flush()

    return cut


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, and row (a struct of the carried columns; null where kept is false)."""
    carry = carry or []
    norm = F.translate(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), SPACES, "")
    row = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(None).cast("string").alias("none"))
    keyed = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.length(F.col(f"`{text_col}`")), F.lit(0)).alias("chars"),
        norm.alias("norm"),
        row.alias("row"),
    ).select("id", "chars", utf8("norm").alias("norm"), F.substring("norm", 1, KEY_CHARS).alias("lead"), F.sha2(F.col("norm"), 256).alias("digest"), "row")
    order = [F.col("lead"), F.col("digest"), F.col("chars").desc(), F.col("id").asc_nulls_last()]
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    carried = pa.struct([pa.field(f.name, _arrow(f.dataType)) for f in placed.schema["row"].dataType.fields])
    schema = T.StructType([*_OUT.fields, T.StructField("row", placed.schema["row"].dataType)])
    runs = written(placed.select("id", "norm", "digest", "row").mapInArrow(_runs(carried), schema), "runs")

    # Runs at the edges of partitions: at most two a partition, so this table follows the number of partitions, not of rows.
    edges = runs.where("edge").groupBy("part", "run").agg(F.first("digest").alias("digest"), F.first("run_keep").alias("run_keep"), F.first("run_size").alias("run_size"))
    line = Window.orderBy("part", "run")
    islands = edges.withColumn("begins", (~F.col("digest").eqNullSafe(F.lag("digest").over(line))).cast("int")).withColumn("island", F.sum("begins").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("island").orderBy("part", "run").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    joined = islands.select(
        "part", "run", (F.col("begins") == 1).alias("opens"), F.first("run_keep").over(whole).alias("whole_keep"), F.sum("run_size").over(whole).alias("whole_size"), F.count("*").over(whole).alias("pieces")
    ).where("pieces > 1")
    kept = F.col("head") & F.coalesce(F.col("opens"), F.lit(True))
    return runs.join(joined, ["part", "run"], "left").select(
        "id",
        F.when(F.col("pieces").isNotNull(), F.col("whole_keep")).otherwise(F.col("run_keep")).alias("keep_id"),
        F.coalesce("whole_size", "run_size").alias("group_size"),
        kept.alias("kept"),
        F.col("digest").alias("text_sha256"),
        F.when(kept, F.col("row")).alias("row"),
    )


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents; dropped ones too."""
    return exact_dedup(table(spark, sf_dir, "documents")).drop("row").withColumnRenamed("id", "doc_id")


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of docs that stay, with docs' columns."""
    return exact_dedup(docs, carry=docs.columns).where("kept").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


ORACLE = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
  FROM documents
), r AS (
  SELECT doc_id, text_sha256,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""
