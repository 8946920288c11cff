"""Files of any store that driver and tasks share: a mounted path, or whatever pyarrow's file systems know (hdfs, s3, gs)."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK = 8 << 20


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri.rstrip("/") or "/"
    store, path = fs.FileSystem.from_uri(uri if "://" in uri else "file://" + uri[5:])
    return store, path.rstrip("/")


def exists(uri: str) -> bool:
    store, path = opened(uri)
    return store.get_file_info(path).type != fs.FileType.NotFound


def put(uri: str, data: bytes) -> None:
    """Writes a file under a temporary name and moves it into place."""
    store, path = opened(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(temporary) as out:
        out.write(data)
    store.move(temporary, path)


def get(uri: str) -> bytes:
    store, path = opened(uri)
    with store.open_input_stream(path) as f:
        return f.read()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir); a local one where that is unset, as in tests."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir() or "/tmp/checkpoints/tickloom"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once as Parquet to a scratch path and read again, so that several branches don't compute it anew."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def sha256_of(uri: str, chunk: int = CHUNK) -> str:
    """The digest of a file of any size; holds one chunk of it. A folder's is that of its files' names and digests, hidden ones left out."""
    store, path = opened(uri)
    digest = hashlib.sha256()
    if store.get_file_info(path).type == fs.FileType.Directory:
        inside = sorted((f.base_name, f.path) for f in store.get_file_info(fs.FileSelector(path)) if f.base_name[0] not in "._")
        for name, at in inside:
            digest.update(f"{name}:{sha256_of(uri.rstrip('/') + '/' + at.rpartition('/')[2], chunk)}\n".encode())
        return digest.hexdigest()
    with store.open_input_stream(path) as f:
        while part := f.read(chunk):
            digest.update(part)
    return digest.hexdigest()


def digests(paths: DataFrame, col: str = "path") -> DataFrame:
    """paths with sha256: each file is streamed by one task, in constant memory."""
    names = [*paths.columns, "sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sha256_of(p) for p in batch.column(col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=names)

    spread = paths.repartition(F.col(col))
    return spread.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*paths.schema.fields]) + ", sha256 string")
